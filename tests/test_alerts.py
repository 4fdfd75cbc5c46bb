"""Alerts about the trade that passes the limit: stream and batch."""

from __future__ import annotations

import random
from dataclasses import replace

import pytest

from blotter.config import Config
from blotter.operators.cleaning import clean
from blotter.streaming import alerts
from tests.conftest import GOOD, trade

CFG = replace(Config(root="unused"), velocity_max_trades=3)
SCHEMA = ", ".join(f"{n} string" for n in GOOD)


def rows_of(*trades):
    return [tuple(None if t.get(n) is None else str(t[n]) for n in GOOD) for t in trades]


def made(seed: int, n: int) -> list[dict]:
    rng = random.Random(seed)
    out = []
    for i in range(n):
        hour, minute = rng.randrange(9, 13), rng.randrange(60)
        out.append(
            trade(trade_id=f"{seed}-{i}", trader_id=f"TDR_{rng.choice([0, 0, 0, 1, 2, 3]):03d}",
                  trade_timestamp=f"2026-01-05T{hour:02d}:{minute:02d}:{rng.randrange(60):02d}")
        )
    return sorted(out, key=lambda t: t["trade_timestamp"])


@pytest.fixture
def stream(spark, tmp_path):
    folder = tmp_path / "trades"
    folder.mkdir()
    before = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    alerts.state_store(spark)

    def run(*batches: list[dict]) -> list:
        for batch in batches:
            df = spark.createDataFrame(rows_of(*batch), SCHEMA).coalesce(1)
            df.write.mode("append").json(str(folder))
        given = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).json(str(folder))
        found = alerts.velocity_alerts(clean(given), CFG, "5 minutes")
        query = (
            found.writeStream.format("parquet").option("path", str(tmp_path / "out"))
            .option("checkpointLocation", str(tmp_path / "checkpoint")).trigger(availableNow=True).start()
        )
        query.awaitTermination()
        return spark.read.schema(alerts.ALERT).parquet(str(tmp_path / "out")).collect()

    yield run
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", before)


def test_stream_equals_batch(spark, stream):
    trades = made(1, 60)
    third = len(trades) // 3
    # Repeated trades, in the same batch and in a later one, after a restart from the checkpoint too.
    first = stream(trades[:third] + trades[:3], trades[third : 2 * third] + trades[third - 3 : third])
    found = stream(trades[2 * third :] + trades[2 * third - 2 : 2 * third])
    batch = alerts.passing_trades(clean(spark.createDataFrame(rows_of(*trades), SCHEMA)), CFG).collect()
    assert 3 < len(batch) and len(first) < len(found)
    assert sorted(map(tuple, found)) == sorted(map(tuple, batch))


def test_trades_after_the_watermark_raise_nothing(stream):
    early = [trade(trade_id=f"a{i}", trade_timestamp="2026-01-05T09:10:00") for i in range(3)]
    later = [trade(trade_id="b", trade_timestamp="2026-01-05T12:00:00", trader_id="TDR_009")]
    assert stream(early, later, later) == []
    # The fourth trade of an hour that was closed by the watermark.
    assert stream([trade(trade_id="late", trade_timestamp="2026-01-05T09:20:00")]) == []


def test_state_is_bounded_by_the_limit(stream):
    many = [trade(trade_id=f"t{i:03d}", trade_timestamp=f"2026-01-05T09:{i % 60:02d}:00") for i in range(200)]
    (alert,) = stream(many[:100], many[100:])
    assert alert.trades_in_hour == 4
