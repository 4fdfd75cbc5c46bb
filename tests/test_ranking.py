"""Ranks over a whole table, cut into parts or not."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from blotter.config import Config
from blotter.operators import features
from blotter.operators.ranking import descending, with_place, with_ranks


@pytest.mark.parametrize("partitions", ["1", "3", "40"])
def test_rank_and_place_equal_sorting(spark, partitions):
    rng = random.Random(4)
    values = [rng.choice([None, *range(40)]) for _ in range(300)] + [7] * 150
    other = [rng.random() for _ in values]
    df = spark.createDataFrame(
        [(i, v, o) for i, (v, o) in enumerate(zip(values, other))], "id int, v int, o double"
    )
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        orders = {"place": descending(F.col("v")), "by_o": F.struct("o")}
        ranked = with_ranks(df, orders, ["id"])
        assert dict(ranked.dtypes)["place"] == "int"
        found = ranked.collect()
        placed = with_place(df, descending(F.col("v")), "nth", ["id"]).collect()
        assert with_ranks(df.limit(0), orders, ["id"]).collect() == []
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    key = lambda v: (v is None, -(v or 0))
    ordered = sorted(key(v) for v in values)
    assert len(found) == len(values)
    for r in found:
        assert r.place == ordered.index(key(r.v)) + 1
        assert r.by_o == sorted(other).index(r.o) + 1
    assert [r.id for r in sorted(placed, key=lambda r: r.nth)] == sorted(
        range(len(values)), key=lambda i: (key(values[i]), i)
    )
    assert sorted(r.nth for r in placed) == list(range(1, len(values) + 1))


def test_two_rates_for_one_instrument_are_an_error(spark):
    trades = spark.createDataFrame([("a", "GBPUSD", 1)], "trade_id string, instrument string, notional int")
    trades = trades.withColumn("notional", F.col("notional").cast("decimal(24,4)"))
    rates = spark.createDataFrame([("gbpusd", "2.0"), (None, "9"), (None, "8")], "instrument string, rate string")
    rates = rates.withColumn("rate", F.col("rate").cast("decimal(10,6)"))
    assert features.convert_with(trades, rates).first().notional_eur == 2
    with pytest.raises(Exception, match="more than one rate for GBPUSD"):
        features.convert_with(trades, rates.union(rates)).collect()


def test_many_configured_rates_are_not_broadcast(spark, monkeypatch):
    monkeypatch.setattr(features, "BROADCAST_RATES", 1)
    plan = features.fx_table(spark, Config(root="unused"))._jdf.queryExecution().toString()
    assert "ResolvedHint" not in plan
