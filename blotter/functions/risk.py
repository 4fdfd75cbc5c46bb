"""Risk bands, position direction and alert levels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from blotter.config import Config

# The bands and levels, most severe first.
TIERS = ("HIGH", "MEDIUM", "LOW")
ALERTS = ("CRITICAL", "WARNING", "NORMAL")
POSITIONS = ("LONG", "SHORT", "FLAT")


def is_large(amount_eur: Column, cfg: Config) -> Column:
    """Strictly above the large-trade threshold; null for an unknown amount."""
    return amount_eur > F.lit(cfg.large_trade_eur)


def tier(amount_eur: Column, cfg: Config) -> Column:
    """Band of an amount. An unknown amount falls in the lowest band."""
    high, medium, low = TIERS
    return (
        F.when(amount_eur > F.lit(cfg.high_exposure_eur), high)
        .when(amount_eur > F.lit(cfg.large_trade_eur), medium)
        .otherwise(low)
    )


def exposure_tier(signed_eur: Column, cfg: Config) -> Column:
    return tier(F.abs(signed_eur), cfg)


def alert_level(anomaly: Column, velocity: Column) -> Column:
    """Both signals are critical, either one is a warning. An unknown signal is no signal."""
    critical, warning, normal = ALERTS
    return F.when(anomaly & velocity, critical).when(anomaly | velocity, warning).otherwise(normal)


def worst_alert(critical_trades: Column, warning_trades: Column) -> Column:
    """The most severe level present in a group, from its counts per level."""
    critical, warning, normal = ALERTS
    return (
        F.when(critical_trades > 0, critical).when(warning_trades > 0, warning).otherwise(normal)
    )


def position(net_eur: Column) -> Column:
    long, short, flat = POSITIONS
    return F.when(net_eur > 0, long).when(net_eur < 0, short).otherwise(flat)


def direction_multiplier(direction: Column) -> Column:
    return F.when(direction == "BUY", 1).when(direction == "SELL", -1).otherwise(0)
