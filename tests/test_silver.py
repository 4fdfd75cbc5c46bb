"""Cleaning, features and the activity of a trader, against brute force."""

from __future__ import annotations

import random
from collections import defaultdict
from dataclasses import replace
from datetime import datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from blotter.config import Config
from blotter.operators import cleaning, features
from blotter.operators.segments import SEGMENT, assign_segments, cut_points
from blotter.plans.silver import SILVER_SCHEMA, silver
from tests.conftest import trade

CFG = Config(root="unused")


def test_clean_normalises_and_casts(bronze):
    row = cleaning.clean(
        bronze(trade(instrument=" aapl ", desk="FX", status=" executed", notional="12.34567"))
    ).first()
    assert (row.instrument, row.desk, row.status) == ("AAPL", "Fx", "EXECUTED")
    assert row.notional == Decimal("12.3457")
    assert (str(row.trade_date), row.trade_hour, row.trade_minute) == ("2026-01-05", 9, 30)
    assert row.is_anomaly is False


def test_uncastable_required_fields_drop_the_row(bronze):
    rows = bronze(
        trade(trade_id="ok"),
        trade(trade_id=None),
        trade(trade_id="a", notional="abc"),
        trade(trade_id="b", notional="NaN"),
        trade(trade_id="c", trade_timestamp="soon"),
        trade(trade_id="d", trader_id=None),
        trade(trade_id="e", price="abc"),
    )
    assert sorted(r.trade_id for r in cleaning.clean(rows).collect()) == ["e", "ok"]


def test_cancelled_and_unknown_status_are_dropped_and_counted(bronze):
    rows = bronze(
        trade(trade_id="a"),
        trade(trade_id="b", status="CANCELLED"),
        trade(trade_id="c", status=" cancelled "),
        trade(trade_id="d", status=None),
        trade(trade_id="e", status="PENDING"),
        trade(trade_id=None, status="CANCELLED"),
    )
    kept = cleaning.drop_cancelled(cleaning.clean(rows))
    assert sorted(r.trade_id for r in kept.collect()) == ["a", "e"]
    assert cleaning.intake(rows).first().asDict() == {
        "bronze": 6, "dropped_incomplete": 1, "dropped_cancelled": 2, "dropped_no_status": 1,
    }


def test_silver_contract(bronze):
    df = silver(bronze(trade()), CFG)
    assert dict(df.dtypes) == SILVER_SCHEMA and df.columns == list(SILVER_SCHEMA)
    row = df.first()
    assert row.signed_notional_eur == 100 and row.trader_daily_notional_run == 100
    assert (row.alert_level, row.time_of_day, row.trades_in_hour) == ("NORMAL", "MORNING", 1)


# ---- activity -----------------------------------------------------------------------------


def in_hour(n, hour=9, minute=30, trader="TDR_001", start=0):
    at = datetime(2026, 1, 5, hour, minute)
    return [
        trade(
            trade_id=f"{trader}-{hour}-{minute}-{i:04d}",
            trader_id=trader,
            trade_timestamp=(at + timedelta(seconds=i)).isoformat(),
        )
        for i in range(start, start + n)
    ]


def flags(df):
    return {r.velocity_flag for r in df.select("velocity_flag").collect()}


MODES = {
    "no cuts": dict(cfg=CFG),
    "cuts": dict(cfg=replace(CFG, segment_rows=8)),
    "every row a cut": dict(cfg=replace(CFG, segment_rows=1, samples_per_cut=1, cuts_per_block=2)),
}


@pytest.mark.parametrize("mode", MODES)
@pytest.mark.parametrize(
    ("trades", "expected"),
    [
        (in_hour(10), {False}),
        (in_hour(11), {True}),
        (in_hour(6, hour=9, minute=50) + in_hour(6, hour=10, minute=10), {False}),
    ],
    ids=["ten", "eleven", "two calendar hours"],
)
def test_velocity(bronze, mode, trades, expected):
    rows = features.add_trade_features(cleaning.clean(bronze(*trades)), CFG)
    assert flags(features.add_activity(rows, **MODES[mode])) == expected


def skewed_trades(seed=7, n=3000):
    """A third of the rows in one second of one trader, ties included, the rest spread."""
    rng = random.Random(seed)
    day = datetime(2026, 1, 5)
    out = []
    for i in range(n):
        if i % 3 == 0:
            trader, at = "TDR_001", day + timedelta(hours=9, microseconds=rng.choice([0, 1, 5]))
        else:
            trader = f"TDR_{rng.randint(1, 4):03d}"
            at = day + timedelta(days=rng.randint(0, 2), seconds=rng.randint(0, 86_399))
        out.append((f"t{rng.random():.12f}", trader, at, Decimal(rng.randint(1, 10**6)) / 100))
    return out


def brute_force(trades):
    """Hour counts and running totals by trade, from plain loops."""
    hours, days = defaultdict(int), defaultdict(list)
    for trade_id, trader, at, eur in trades:
        hours[trader, at.date(), at.hour] += 1
        days[trader, at.date()].append((at, trade_id, eur))
    expected = {}
    for (trader, date), rows in days.items():
        total = Decimal(0)
        for at, trade_id, eur in sorted(rows):
            total += eur
            expected[trade_id] = (hours[trader, date, at.hour], total)
    return expected


@pytest.fixture(scope="module")
def skewed(spark):
    trades = skewed_trades()
    schema = "trade_id string, trader_id string, trade_timestamp timestamp, notional_eur decimal(24,4)"
    df = spark.createDataFrame(trades, schema).withColumns(
        {"trade_date": F.to_date("trade_timestamp"), "trade_hour": F.hour("trade_timestamp")}
    )
    return trades, df.repartition(8)


@pytest.mark.parametrize(
    ("segment_rows", "samples_per_cut", "cuts_per_block"),
    [(10**6, 8, 128), (8, 8, 128), (8, 8, 3), (64, 8, 128), (1, 1, 2), (3, 1, 1)],
)
def test_activity_equals_brute_force(skewed, segment_rows, samples_per_cut, cuts_per_block):
    trades, df = skewed
    cfg = replace(
        CFG, segment_rows=segment_rows, samples_per_cut=samples_per_cut, cuts_per_block=cuts_per_block
    )
    got = {
        r.trade_id: (r.trades_in_hour, r.trader_daily_notional_run)
        for r in features.add_activity(df, cfg).collect()
    }
    assert got == brute_force(trades)


def test_segments_follow_the_order_and_split_the_hot_hour(skewed):
    trades, df = skewed
    cfg = replace(CFG, segment_rows=8)
    rows = assign_segments(df, features.TRADER_HOUR, features.TIME_ORDER, cfg)
    groups = defaultdict(list)
    for r in rows.collect():
        key = (r.trader_id, r.trade_date, r.trade_hour)
        groups[key].append(((r.trade_timestamp, r.trade_id), r[SEGMENT]))
    for members in groups.values():
        segments = [segment for _, segment in sorted(members)]
        assert segments == sorted(segments)
    hot = max(groups.values(), key=len)
    sizes = defaultdict(int)
    for _, segment in hot:
        sizes[segment] += 1
    # More than one block of cuts, so both lookups are used; no segment is far above its size.
    assert len(hot) >= 1000 and len(sizes) > 100
    assert max(sizes.values()) <= 8


def test_one_cut_per_segment_at_any_size(skewed):
    trades, df = skewed
    cuts = lambda **kw: cut_points(
        df, features.TRADER_HOUR, features.TIME_ORDER, replace(CFG, **kw)
    ).count()
    assert 100 < cuts(segment_rows=8) <= len(trades) / 8
    assert cuts(segment_rows=64) <= 2 * len(trades) / 64
    assert cuts() == 0


def test_a_joined_cut_table_gives_the_same(skewed, spark):
    """The cuts need not be broadcast."""
    trades, df = skewed
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    try:
        rows = features.add_activity(df, replace(CFG, segment_rows=8)).collect()
    finally:
        spark.conf.set(key, before)
    assert {
        r.trade_id: (r.trades_in_hour, r.trader_daily_notional_run) for r in rows
    } == brute_force(trades)


def test_unknown_amounts_do_not_break_the_running_total(skewed, spark):
    schema = "trade_id string, trader_id string, trade_timestamp timestamp, notional_eur decimal(24,4)"
    at = datetime(2026, 1, 5, 9)
    rows = [("a", "T", at, None), ("b", "T", at, Decimal(2)), ("c", "T", at, None)]
    df = spark.createDataFrame(rows, schema).withColumns(
        {"trade_date": F.to_date("trade_timestamp"), "trade_hour": F.hour("trade_timestamp")}
    )
    for cfg in (CFG, replace(CFG, segment_rows=1)):
        got = features.add_activity(df, cfg).orderBy("trade_id").collect()
        assert [r.trader_daily_notional_run for r in got] == [None, 2, 2]
