"""Bronze to Silver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from blotter.config import Config
from blotter.functions import money
from blotter.operators.cleaning import clean, drop_cancelled
from blotter.operators.features import engineer

# The Silver contract, in order.
SILVER_SCHEMA = {
    "trade_id": "string",
    "trader_id": "string",
    "instrument": "string",
    "direction": "string",
    "desk": "string",
    "region": "string",
    "counterparty": "string",
    "status": "string",
    "notional": money.AMOUNT,
    "notional_eur": money.AMOUNT,
    "signed_notional_eur": money.AMOUNT,
    "price": money.PRICE,
    "trade_timestamp": "timestamp",
    "trade_date": "date",
    "trade_hour": "int",
    "trade_minute": "int",
    "time_of_day": "string",
    "is_large_trade": "boolean",
    "risk_tier": "string",
    "velocity_flag": "boolean",
    "trades_in_hour": "int",
    "trader_daily_notional_run": money.RUNNING,
    "alert_level": "string",
    "is_anomaly": "boolean",
    "_ingested_at": "timestamp",
    "_source": "string",
}


SILVER_DDL = ", ".join(f"{name} {kind}" for name, kind in SILVER_SCHEMA.items())


def conform(featured: DataFrame) -> DataFrame:
    """Exactly the Silver columns, in order and with their types."""
    return featured.select(*[F.col(name).cast(kind) for name, kind in SILVER_SCHEMA.items()])


def silver(bronze: DataFrame, cfg: Config, rates: DataFrame | None = None) -> DataFrame:
    """The Silver table of a Bronze table (the twelve raw fields and two lineage columns)."""
    return conform(engineer(drop_cancelled(clean(bronze)), cfg, rates))
