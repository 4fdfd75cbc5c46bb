"""Trades per trader and event-time window."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from blotter.config import Config


def velocity_counts(trades: DataFrame, cfg: Config, lateness: str = "10 minutes") -> DataFrame:
    """Trades per trader and window, final once the watermark passes the window.

    Works on a stream and on a table. A repeated trade has the trader and time of the first,
    so it falls in the same window and is counted once: the first grouping collapses repeats,
    already in the map tasks, where a plain drop of duplicates would shuffle all of them.
    """
    window = F.window("trade_timestamp", f"{cfg.velocity_window_minutes} minutes")
    once = (
        trades.withWatermark("trade_timestamp", lateness)
        .groupBy(window.alias("window"), "trader_id", "trade_id")
        .agg(F.count(F.lit(1)).alias("copies"))
    )
    counted = once.groupBy("window", "trader_id").agg(F.count(F.lit(1)).alias("trades_in_window"))
    return counted.select(
        "trader_id",
        F.col("window.start").alias("window_start"),
        F.col("window.end").alias("window_end"),
        "trades_in_window",
        (F.col("trades_in_window") > cfg.velocity_max_trades).alias("velocity_flag"),
    )
