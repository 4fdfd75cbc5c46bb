"""Bronze to typed, normalised rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from blotter.functions.money import AMOUNT, PRICE
from blotter.functions.text import code, title

# A trade without one of these cannot be attributed or valued.
REQUIRED = ("trade_id", "trader_id", "notional", "trade_timestamp")


def normalise(bronze: DataFrame) -> DataFrame:
    """Normalise text and cast types; what does not cast becomes null."""
    col = F.col
    typed = bronze.withColumns(
        {name: code(col(name)) for name in ("instrument", "trader_id", "direction", "region", "status")}
        | {
            "desk": title(col("desk")),
            "counterparty": F.trim("counterparty"),
            "notional": col("notional").try_cast(AMOUNT),
            "price": col("price").try_cast(PRICE),
            "trade_timestamp": col("trade_timestamp").try_cast("timestamp"),
            "is_anomaly": col("is_anomaly").try_cast("boolean"),
        }
    )
    moment = col("trade_timestamp")
    return typed.withColumns(
        {
            "trade_date": F.to_date(moment),
            "trade_hour": F.hour(moment),
            "trade_minute": F.minute(moment),
        }
    )


def clean(bronze: DataFrame) -> DataFrame:
    """Normalised rows that have every required field."""
    return normalise(bronze).dropna(subset=list(REQUIRED))


def drop_cancelled(trades: DataFrame) -> DataFrame:
    """Cancelled trades carry no exposure; a trade of unknown status is dropped with them."""
    return trades.where(F.col("status") != "CANCELLED")


def intake(bronze: DataFrame) -> DataFrame:
    """One row: how many Bronze rows go into Silver, and why the others do not."""
    incomplete = F.lit(False)
    for name in REQUIRED:
        incomplete = incomplete | F.col(name).isNull()
    status = F.col("status")
    return normalise(bronze).agg(
        F.count(F.lit(1)).alias("bronze"),
        F.count_if(incomplete).alias("dropped_incomplete"),
        F.count_if(~incomplete & (status == "CANCELLED")).alias("dropped_cancelled"),
        F.count_if(~incomplete & status.isNull()).alias("dropped_no_status"),
    )
