"""The trade that takes a trader over the hourly limit, flagged while trades stream.

A trader-hour's state is the ids of its first trades, one more than the limit at most: repeated trades
are told apart, and once the limit is passed nothing more has to be kept, so a trader with a third of all
trades holds no more state than any other. A timer drops it when the watermark passes the hour.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from blotter.config import Config
from blotter.operators.features import TIME_ORDER, TRADER_HOUR

ALERT = "trader_id string, trade_date date, trade_hour int, trade_id string, trade_timestamp timestamp, trades_in_hour int"

_HOUR_MS = 3_600_000
_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def passing_trades(trades: DataFrame, cfg: Config) -> DataFrame:
    """The same of a whole table: per trader-hour over the limit, the trade that passes it in time order.

    Of an hour only its first trades travel: Spark keeps so many per map task (a window group limit).
    """
    number = F.row_number().over(Window.partitionBy(*TRADER_HOUR).orderBy(*TIME_ORDER))
    first = trades.withColumn("trades_in_hour", number).where(
        F.col("trades_in_hour") <= cfg.velocity_max_trades + 1
    )
    passing = first.where(F.col("trades_in_hour") == cfg.velocity_max_trades + 1)
    return passing.select(*TRADER_HOUR, "trade_id", "trade_timestamp", "trades_in_hour")


class HourWatch(StatefulProcessor):
    """Counts the different trades of a trader-hour up to the one that passes the limit."""

    def __init__(self, limit: int) -> None:
        self._limit = limit

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._handle = handle
        self._known = handle.getMapState("known", "trade_id string", "n int")

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        known = {name[0] for name in self._known.keys()}
        if not known:
            # An hour that was dropped is over: its late trades come after the watermark and not here.
            self._handle.registerTimer(self._end(key))
        for part in rows:
            if len(known) > self._limit:
                continue
            for row in part.sort_values(["trade_timestamp", "trade_id"]).itertuples():
                if row.trade_id in known:
                    continue
                known.add(row.trade_id)
                self._known.updateValue((row.trade_id,), (len(known),))
                if len(known) > self._limit:
                    yield self._alert(key, row, len(known))
                    break

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[pd.DataFrame]:
        self._known.clear()
        return iter(())

    def close(self) -> None:
        pass

    @staticmethod
    def _end(key: Any) -> int:
        _, date, hour = key
        return int(pd.Timestamp(date).timestamp() * 1000) + (hour + 1) * _HOUR_MS

    @staticmethod
    def _alert(key: Any, row: Any, n: int) -> pd.DataFrame:
        trader, date, hour = key
        return pd.DataFrame(
            {
                "trader_id": [trader], "trade_date": [date], "trade_hour": [hour], "trade_id": [row.trade_id],
                "trade_timestamp": [row.trade_timestamp], "trades_in_hour": [n],
            }
        )


def state_store(spark: SparkSession) -> None:
    """The state store that timers and maps need; set it before the stream starts."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", _ROCKSDB)


def velocity_alerts(trades: DataFrame, cfg: Config, lateness: str = "10 minutes") -> DataFrame:
    """A stream of clean trades to a stream of alerts, one per trader-hour over the limit.

    Trades of one batch count in time order, later batches after earlier ones. Which trade passes the
    limit depends on how they arrive; which trader-hours do is the same as in the batch.
    """
    narrow = trades.withWatermark("trade_timestamp", lateness).select(*TRADER_HOUR, *TIME_ORDER[::-1])
    return narrow.groupBy(*TRADER_HOUR).transformWithStateInPandas(
        HourWatch(cfg.velocity_max_trades), ALERT, "append", "eventTime"
    )
