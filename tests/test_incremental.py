"""Distinct counts by bitmaps, and marts kept up to date date by date."""

from __future__ import annotations

import os
import random
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from blotter.operators import bitmaps
from blotter.plans import gold, incremental, jobs
from blotter.sources.tables import read_gold, read_table
from tests.conftest import line


def test_bitmaps_count_distinct_values(spark):
    rng = random.Random(1)
    rows = [(rng.choice("abc"), rng.choice([None, *(f"v{n}" for n in range(400))])) for _ in range(5000)]
    df = spark.createDataFrame(rows, "k string, v string")
    numbers = bitmaps.numbered(df.select("v"))
    got = sorted(r.number for r in numbers.collect())
    assert got == list(range(1, len({v for _, v in rows if v}) + 1))
    # Far apart, so that they fall in several bitmaps.
    wide = numbers.withColumn("number", F.col("number") * 1000)
    joined = df.join(wide, F.col("v") == F.col("value"))
    halves = [bitmaps.sets(joined.where(half), ["k"]) for half in ("number % 2000 = 0", "number % 2000 <> 0", "true")]
    parts = halves[0].unionByName(halves[1]).unionByName(halves[2])
    found = {r.k: r.n for r in bitmaps.sizes(parts, ["k"], "n").collect()}
    assert found == {k: len({v for key, v in rows if key == k and v}) for k in "abc"}


def test_numbers_go_on(spark):
    values = lambda *v: spark.createDataFrame([(x,) for x in v], "v string")
    first = bitmaps.numbered(values("b", "a", None, "a"))
    known = {r.value: r.number for r in first.collect()}
    assert known == {"a": 1, "b": 2}
    more = bitmaps.numbered(values("b", "c", "A"), first)
    assert {r.value: r.number for r in more.collect()} == {"A": 3, "c": 4}
    assert bitmaps.numbered(values("a"), first).collect() == []


def lines(day: int, n: int, seed: int, **changes) -> list[str]:
    rng = random.Random(seed)
    return [
        line(
            trade_id=f"{seed}-{i}",
            trader_id=f"TDR_{rng.randrange(4):03d}",
            instrument=rng.choice(["AAPL", "MSFT", "GOLD"]),
            region=rng.choice(["EMEA", "APAC"]),
            direction=rng.choice(["BUY", "SELL"]),
            status=rng.choice(["EXECUTED", "CANCELLED", "PENDING"]),
            notional=rng.randrange(1, 10**6),
            trade_timestamp=f"2026-01-{day:02d}T{rng.randrange(24):02d}:10:00",
            is_anomaly=rng.random() < 0.2,
            **changes,
        )
        for i in range(n)
    ]


@pytest.fixture
def load(spark, cfg, tmp_path):
    def run(*found: str) -> dict:
        path = tmp_path / f"load{len(list(tmp_path.iterdir()))}.jsonl"
        path.write_text("\n".join(found) + "\n")
        jobs.ingest(spark, str(path), cfg)
        return incremental.refresh(spark, jobs.bronze(spark, cfg), cfg)

    return run


def files(folder: str) -> dict[str, float]:
    return {str(p): os.stat(p).st_mtime_ns for p in Path(folder).rglob("*.parquet")}


def rows(df) -> list[str]:
    return sorted(repr(sorted(r.asDict().items())) for r in df.collect())


def test_a_second_load_rewrites_its_dates_only(spark, cfg, load):
    assert [str(d) for d in load(*lines(5, 30, 1), *lines(6, 30, 2))["dates"]] == ["2026-01-05", "2026-01-06"]
    folders = [cfg.silver_path, cfg.gold_path("mart_daily_volume")]
    folders += [incremental.state_path(cfg, name) for name in ("exposure", "instruments", "seen")]
    before = [files(folder) for folder in folders]
    # A late trade of the second date, of a trader and a region not seen before.
    late = line(trade_id="late", trader_id="TDR_900", region="AMER", trade_timestamp="2026-01-06T03:00:00")
    assert [str(d) for d in load(late, *lines(5, 30, 1))["dates"]] == ["2026-01-06"]
    for folder, old in zip(folders, before):
        new = files(folder)
        changed = {name for name in old.keys() | new.keys() if old.get(name) != new.get(name)}
        assert changed and all("trade_date=2026-01-06" in name for name in changed)

    merged = {t: rows(read_gold(spark, t, cfg)) for t in gold.MARTS}
    silver = rows(read_table(spark, cfg.silver_path, cfg))
    jobs.transform(spark, cfg)
    jobs.build_gold(spark, cfg)
    assert silver == rows(read_table(spark, cfg.silver_path, cfg))
    assert merged == {t: rows(read_gold(spark, t, cfg)) for t in gold.MARTS}


def test_nothing_new_writes_nothing(spark, cfg, load):
    load(*lines(5, 10, 1))
    before = files(cfg.root)
    assert incremental.refresh(spark, jobs.bronze(spark, cfg), cfg) == {"dates": []}
    assert files(cfg.root) == before
