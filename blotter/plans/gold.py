"""Silver to Gold: staging, enrichment, the activity cube and the three marts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from blotter.config import Config
from blotter.functions import clock, money, risk
from blotter.operators.cleaning import drop_cancelled
from blotter.operators.ranking import descending, with_place, with_ranks
from blotter.plans.silver import conform
from blotter.session import checkpointed


def staging(silver: DataFrame) -> DataFrame:
    """Silver in its contract types, without cancelled trades."""
    return conform(drop_cancelled(silver))


def enriched(staged: DataFrame, cfg: Config) -> DataFrame:
    """Staged trades with direction, calendar, exposure and market-hour columns."""
    date = F.col("trade_date")
    return staged.select(
        "*",
        risk.direction_multiplier(F.col("direction")).alias("direction_multiplier"),
        F.dayofweek(date).alias("day_of_week"),
        clock.day_name(date).alias("day_name"),
        F.weekofyear(date).alias("week_number"),
        clock.is_weekend(date).alias("is_weekend"),
        risk.exposure_tier(F.col("signed_notional_eur"), cfg).alias("exposure_tier"),
        clock.is_market_hours(F.col("trade_hour")).alias("is_market_hours"),
    )


# ---- the cube -----------------------------------------------------------------------------
# The trades are read once, into cells of the finest grain any mart needs. Counts, sums and
# extremes of cells combine exactly, and the distinct traders, dates and regions of a mart are
# distinct cell keys, so each mart is a roll-up of the cube instead of a scan of the trades.
# A cell is combined in the map tasks first: a hot one is one row per task in the shuffle.

CUBE_KEYS = ("trade_date", "trader_id", "desk", "instrument", "region")


def _counted() -> dict[str, Column]:
    """Which trades each count of a cell takes."""
    col = F.col
    return {
        "buys": col("direction") == "BUY",
        "sells": col("direction") == "SELL",
        "large": col("is_large_trade"),
        "anomalies": col("is_anomaly"),
        "fast": col("velocity_flag"),
        "critical": col("alert_level") == "CRITICAL",
        "warnings": col("alert_level") == "WARNING",
        "in_market": col("is_market_hours"),
        "off_market": ~col("is_market_hours"),
    }


def activity_cube(trades: DataFrame) -> DataFrame:
    """One row per date, trader, desk, instrument and region of the enriched trades."""
    eur, signed = F.col("notional_eur"), F.col("signed_notional_eur")
    nothing = F.lit(0).cast(money.AMOUNT)
    one_side = lambda side: F.sum(F.when(F.col("direction") == side, eur).otherwise(nothing))
    return trades.groupBy(*CUBE_KEYS).agg(
        F.count("trade_id").alias("trades"),
        F.count("notional_eur").alias("valued"),
        F.sum(eur).alias("eur"),
        F.min(eur).alias("eur_min"),
        F.max(eur).alias("eur_max"),
        one_side("BUY").alias("eur_bought"),
        one_side("SELL").alias("eur_sold"),
        F.sum(signed).alias("eur_net"),
        *[F.count_if(which).alias(name) for name, which in _counted().items()],
    )


_EXTREMES = {"eur_min": F.min, "eur_max": F.max}


def rolled_up(cells: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Coarser cells with the same measures: counts, sums and extremes combine."""
    measures = [name for name in cells.columns if name not in CUBE_KEYS]
    return cells.groupBy(*keys).agg(
        *[
            _EXTREMES.get(name, F.sum)(name).cast(cells.schema[name].dataType).alias(name)
            for name in measures
        ]
    )


def _count(measure: str, name: str) -> Column:
    return F.sum(measure).alias(name)


def _money(measure: str, name: str) -> Column:
    return F.sum(measure).cast(money.TOTAL).alias(name)


def _average(name: str) -> Column:
    """Mean amount of the valued trades, exact up to its eighth decimal."""
    mean = F.sum("eur").cast(money.TOTAL) / F.nullif(F.sum("valued"), F.lit(0))
    return mean.cast(money.AVERAGE).alias(name)


def _present(measure: str, name: str) -> Column:
    """1 when any trade of the group was counted by the measure, else 0."""
    return F.when(F.sum(measure) > 0, 1).otherwise(0).alias(name)


# ---- the marts ----------------------------------------------------------------------------
# A mart is a table, which has no row order; `ranked_*` below put the rows in reading order.


def daily_volume(cube: DataFrame) -> DataFrame:
    """Volume per date, desk, instrument and region."""
    date = F.col("trade_date")
    totals = cube.groupBy("trade_date", "desk", "instrument", "region").agg(
        _count("trades", "trade_count"),
        _money("eur", "total_notional_eur"),
        _average("avg_notional_eur"),
        F.min("eur_min").alias("min_notional_eur"),
        F.max("eur_max").alias("max_notional_eur"),
        _money("eur_bought", "buy_volume_eur"),
        _money("eur_sold", "sell_volume_eur"),
        _money("eur_net", "net_volume_eur"),
        _count("buys", "buy_count"),
        _count("sells", "sell_count"),
        _count("large", "large_trade_count"),
        _count("anomalies", "anomaly_count"),
        _count("fast", "velocity_flagged_count"),
        _count("critical", "critical_alert_count"),
        _count("warnings", "warning_alert_count"),
        _count("in_market", "market_hours_count"),
        _count("off_market", "after_hours_count"),
    )
    keys = ["trade_date", "desk", "instrument", "region"]
    of_trades = lambda part, name: money.percent(F.col(part), F.col("trade_count")).alias(name)
    return totals.select(
        *keys,
        # These follow from the date, so they are added after the grouping.
        clock.day_name(date).alias("day_name"),
        F.weekofyear(date).alias("week_number"),
        clock.is_weekend(date).alias("is_weekend"),
        *totals.columns[len(keys):],
        of_trades("anomaly_count", "anomaly_rate_pct"),
        of_trades("buy_count", "buy_pct"),
        of_trades("sell_count", "sell_pct"),
    )


def risk_exposure(cube: DataFrame, cfg: Config) -> DataFrame:
    """Net and gross exposure per trader, desk and region."""
    totals = cube.groupBy("trader_id", "desk", "region").agg(
        _count("trades", "total_trades"),
        _count("buys", "buy_trades"),
        _count("sells", "sell_trades"),
        _money("eur_net", "net_exposure_eur"),
        _money("eur_bought", "gross_long_eur"),
        _money("eur_sold", "gross_short_eur"),
        _money("eur", "total_notional_eur"),
        _average("avg_trade_size_eur"),
        F.max("eur_max").alias("largest_trade_eur"),
        _present("fast", "has_velocity_flag"),
        _present("large", "has_large_trade"),
        _present("anomalies", "has_anomaly"),
        _count("fast", "velocity_flagged_trades"),
        _count("anomalies", "anomaly_trades"),
        _present("critical", "has_critical_alert"),
        _present("warnings", "has_warning_alert"),
        risk.worst_alert(F.sum("critical"), F.sum("warnings")).alias("worst_alert_level"),
        F.min("trade_date").alias("first_trade_date"),
        F.max("trade_date").alias("last_trade_date"),
        F.count_distinct("trade_date").alias("active_trading_days"),
    )
    net = F.col("net_exposure_eur")
    rate = money.percent(F.col("anomaly_trades"), F.col("total_trades"))
    return totals.select(
        "*",
        risk.exposure_tier(net, cfg).alias("exposure_risk_tier"),
        risk.position(net).alias("position_direction"),
        rate.alias("anomaly_rate_pct"),
    )


# The columns of the totals, in order.
INSTRUMENT_TOTALS = (
    "instrument", "desk", "trade_count", "total_volume_eur", "avg_trade_size_eur", "min_trade_size_eur",
    "max_trade_size_eur", "buy_volume_eur", "sell_volume_eur", "net_volume_eur", "unique_traders",
    "active_days", "active_regions", "anomaly_count", "velocity_flagged_count", "large_trade_count",
    "critical_alert_count", "first_trade_date", "last_trade_date",
)


def instrument_totals(cube: DataFrame, distinct: bool = True) -> DataFrame:
    """Volume and activity per instrument and desk.

    Without `distinct`, the cells may lack traders and regions, whose counts are then left out.
    """
    apart = ["trader_id", "region"] if distinct else []
    names = {"trader_id": "unique_traders", "region": "active_regions"}
    counts = [F.count_distinct(column).alias(names[column]) for column in apart]
    order = [name for name in INSTRUMENT_TOTALS if distinct or name not in names.values()]
    return cube.groupBy("instrument", "desk").agg(
        _count("trades", "trade_count"),
        _money("eur", "total_volume_eur"),
        _average("avg_trade_size_eur"),
        F.min("eur_min").alias("min_trade_size_eur"),
        F.max("eur_max").alias("max_trade_size_eur"),
        _money("eur_bought", "buy_volume_eur"),
        _money("eur_sold", "sell_volume_eur"),
        _money("eur_net", "net_volume_eur"),
        *counts,
        F.count_distinct("trade_date").alias("active_days"),
        _count("anomalies", "anomaly_count"),
        _count("fast", "velocity_flagged_count"),
        _count("large", "large_trade_count"),
        _count("critical", "critical_alert_count"),
        F.min("trade_date").alias("first_trade_date"),
        F.max("trade_date").alias("last_trade_date"),
    ).select(*order)


def top_instruments(cube: DataFrame) -> DataFrame:
    """Volume, activity, shares and ranks per instrument and desk.

    The totals are computed and stored here: the grand total and both ranks are read from them.
    """
    return with_shares_and_ranks(instrument_totals(cube))


def with_shares_and_ranks(totals: DataFrame) -> DataFrame:
    """The mart from the totals per instrument and desk."""
    col = F.col
    volume = col("total_volume_eur")
    orders = {"volume_rank": descending(volume), "anomaly_rank": descending(col("anomaly_count"))}
    stored = checkpointed(totals)
    whole_market = stored.select(F.sum(volume)).scalar()
    ranked = with_ranks(stored, orders, GRAINS["mart_top_instruments"])
    return ranked.select(
        *totals.columns,
        money.percent(col("anomaly_count"), col("trade_count")).alias("anomaly_rate_pct"),
        money.percent(col("large_trade_count"), col("trade_count")).alias("large_trade_rate_pct"),
        money.percent(col("buy_volume_eur"), volume).alias("buy_volume_pct"),
        money.percent(volume, whole_market).alias("volume_share_pct"),
        *orders,
    )


# ---- reading order and previews -----------------------------------------------------------

READING_ORDER = {
    "mart_daily_volume": lambda: [
        F.col("trade_date").desc(), F.col("total_notional_eur").desc(),
        F.col("desk"), F.col("instrument"), F.col("region"),
    ],
    "mart_risk_exposure": lambda: [
        F.abs("net_exposure_eur").desc(), F.col("trader_id"), F.col("desk"), F.col("region"),
    ],
    "mart_top_instruments": lambda: [F.col("volume_rank"), F.col("instrument"), F.col("desk")],
}


def in_reading_order(mart: DataFrame, name: str) -> DataFrame:
    """The rows as a reader sees them; the keys at the end make the order total."""
    return mart.orderBy(*READING_ORDER[name]())


# The same orders as ascending keys, for a position that is stored with the row.
READING_KEY = {
    "mart_daily_volume": lambda: F.struct(
        -F.unix_date("trade_date"), descending(F.col("total_notional_eur")), "desk", "instrument", "region",
    ),
    "mart_risk_exposure": lambda: F.struct(
        descending(F.abs("net_exposure_eur")), "trader_id", "desk", "region"
    ),
    "mart_top_instruments": lambda: F.struct("volume_rank", "instrument", "desk"),
}


def with_position(mart: DataFrame, name: str) -> DataFrame:
    """Add each row's place in reading order, from 1 on. The mart is stored for that."""
    return with_place(checkpointed(mart), READING_KEY[name](), "position", GRAINS[name])


def latest_days(daily: DataFrame, n: int = 5) -> DataFrame:
    return in_reading_order(daily, "mart_daily_volume").limit(n)


def top_exposures(exposure: DataFrame, n: int = 5) -> DataFrame:
    return in_reading_order(exposure, "mart_risk_exposure").limit(n).select(
        "trader_id", "desk", "net_exposure_eur", "exposure_risk_tier", "worst_alert_level"
    )


def instrument_ranking(instruments: DataFrame) -> DataFrame:
    return in_reading_order(instruments, "mart_top_instruments").select(
        "instrument", "desk", "trade_count", "total_volume_eur", "anomaly_rate_pct", "volume_rank"
    )


MARTS = {
    "mart_daily_volume": lambda cube, cfg: daily_volume(cube),
    "mart_risk_exposure": risk_exposure,
    "mart_top_instruments": lambda cube, cfg: top_instruments(cube),
}

# The columns that tell the rows of a mart apart.
GRAINS = {
    "mart_daily_volume": ("trade_date", "desk", "instrument", "region"),
    "mart_risk_exposure": ("trader_id", "desk", "region"),
    "mart_top_instruments": ("instrument", "desk"),
}
