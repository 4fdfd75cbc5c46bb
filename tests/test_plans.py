"""What the physical plans must and must not contain."""

from __future__ import annotations

import re
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from blotter.config import Config
from blotter.operators import features, insert_only, quality, validate
from blotter.operators.segments import cut_points
from blotter.plans import gold, jobs
from blotter.sinks import tables as sink
from blotter.sources import trades_view
from checks import registry
from tests.conftest import SMALL
from tests.plans import executed_plan, formatted_plan, has_python, shuffles

CFG = Config(root="unused")


@pytest.fixture(scope="module")
def featured(spark):
    return registry._featured(spark, SMALL)


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_no_python_and_no_cross_join_in_any_query(spark, name):
    plan = registry.queries()[name](spark, SMALL)
    text = executed_plan(plan)
    assert not has_python(plan)
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_activity_windows_run_inside_segments(featured):
    """The wide rows are windowed by segment, whatever their number; no whole trader-day is."""
    plan = executed_plan(features.add_activity(featured, CFG))
    wide = [row for row in plan.splitlines() if "Window [sum(notional_eur" in row]
    assert len(wide) == 1 and "_segment" in wide[0]


def test_the_plan_does_not_depend_on_the_number_of_rows(spark):
    def shape(n):
        rows = spark.range(n).selectExpr(
            "concat('t', id) AS trade_id", "concat('TDR_', id % 3) AS trader_id",
            "timestamp_seconds(1767600000 + id % 86400) AS trade_timestamp",
            "CAST(id AS DECIMAL(24,4)) AS notional_eur",
        ).selectExpr("*", "to_date(trade_timestamp) AS trade_date", "hour(trade_timestamp) AS trade_hour")
        plan = executed_plan(features.add_activity(rows, CFG))
        return re.findall(r"[A-Z]\w+(?= |\()", re.sub(r"Range \(.*", "Range", plan))

    # Which side Spark broadcasts does depend on it, unless it broadcasts nothing.
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    try:
        assert shape(10) == shape(10_000_000)
    finally:
        spark.conf.set(key, before)


def test_every_trade_may_be_a_cut(spark):
    """Cut as finely as can be, busy trader-hours have more cuts than a block holds."""
    cut = replace(CFG, segment_rows=1, samples_per_cut=1, cuts_per_block=2)
    found = cut_points(
        registry._featured(spark, "/root/testdata/sf0.01"), features.TRADER_HOUR, features.TIME_ORDER, cut
    ).groupBy(*features.TRADER_HOUR).count()
    most = found.agg({"count": "max"}).first()[0]
    assert found.count() > 1000 and most > cut.cuts_per_block


def test_fine_cuts_change_nothing(spark):
    cut = replace(registry.CFG, segment_rows=1, samples_per_cut=1, cuts_per_block=2)
    featured = registry._featured(spark, SMALL)
    columns = ("trade_id", "trades_in_hour", "velocity_flag", "trader_daily_notional_run")
    whole, fine = (features.add_activity(featured, c).select(*columns) for c in (registry.CFG, cut))
    assert fine.exceptAll(whole).isEmpty() and whole.exceptAll(fine).isEmpty()


def test_no_window_over_everything(spark):
    """What a single task sees of a ranking is one row per partition of the sorted keys."""
    for name in ("mart_top_instruments", "sorted_daily_volume", "instrument_ranking"):
        lines = executed_plan(registry.queries()[name](spark, SMALL)).splitlines()
        windows = [i for i, row in enumerate(lines) if "Window [" in row]
        assert windows and all("_part" in lines[i] for i in windows)


def test_ranking_does_not_read_the_trades_again(spark):
    """The totals are stored; the mart's plan is built on them."""
    assert scans(registry.queries()["mart_top_instruments"](spark, SMALL), "event_id") == 0


def scans(df, column):
    """How many scans of a plan read a column."""
    return sum(column in fields for fields in re.findall(r"ReadSchema: struct<([^>]*)>", executed_plan(df)))


def test_reconciliation_reads_the_events_twice(spark):
    assert scans(registry.queries()["layer_reconciliation"](spark, SMALL), "event_id") <= 2


def test_quality_reads_each_table_twice(spark, tmp_path):
    cfg = replace(CFG, root=str(tmp_path))
    trades_view.bronze(spark, SMALL).selectExpr(
        *[f"CAST({name} AS STRING) AS {name}" for name in validate.FIELDS], "_ingested_at", "_source"
    ).write.parquet(cfg.bronze_path)
    jobs.transform(spark, cfg)
    jobs.build_gold(spark, cfg)
    suite = quality.run_suite(jobs.quality_inputs(spark, cfg), same_rows=quality.SAME_ROWS)
    plan = executed_plan(suite)
    # Silver and two of the marts twice, the daily mart, which declares no key, once.
    assert plan.count("FileScan parquet") == 7
    assert sum("hashpartitioning(trade_id" in row for row in plan.splitlines()) == 1


def test_inserting_does_not_shuffle_a_bucketed_bronze(spark, cfg):
    cfg = replace(cfg, bronze_table="bronze_plan_test", bronze_buckets=16)
    rows = spark.range(5000).selectExpr("concat('t', id) AS trade_id", "id AS at")
    sink.append_bronze(rows, cfg)
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    try:
        batch = spark.range(4990, 5010).selectExpr("concat('t', id) AS trade_id", "id AS at")
        fresh = insert_only.new_rows(batch, jobs.bronze(spark, cfg), "trade_id", F.col("at"))
        plan = executed_plan(fresh)
        lines = plan.splitlines()
        depth = lambda row: len(row) - len(row.lstrip(" :+-"))
        at = next(i for i, row in enumerate(lines) if "bronze_plan_test" in row)
        path = [lines[at]]  # from the scan of Bronze up to the root
        for row in reversed(lines[:at]):
            if depth(row) < depth(path[-1]):
                path.append(row)
        assert sum("SortMergeJoin" in row for row in path) == 2
        assert not any("Exchange" in row for row in path)
        assert fresh.count() == 10
    finally:
        spark.conf.set(key, before)
        spark.sql("DROP TABLE bronze_plan_test")


def test_marts_read_the_cube_not_the_trades(spark):
    """The distinct counts expand cube cells; the trades are grouped before."""
    plan = executed_plan(gold.instrument_totals(registry._cube(spark, SMALL)))
    assert plan.index("Expand") < plan.index("partial_count(trade_id")


def test_scan_reads_only_needed_columns(spark):
    plan = executed_plan(registry.queries()["status_breakdown"](spark, SMALL))
    (events,) = re.findall(r"ReadSchema: struct<([^>]*event_type[^>]*)>", plan)
    assert "value" not in events and "props" not in events


def test_silver_filters_reach_the_files(spark, tmp_path):
    cfg = replace(CFG, root=str(tmp_path))
    trades_view.bronze(spark, SMALL).selectExpr(
        *[f"CAST({name} AS STRING) AS {name}" for name in validate.FIELDS], "_ingested_at", "_source"
    ).write.parquet(cfg.bronze_path)
    jobs.transform(spark, cfg)
    staged = jobs.gold_inputs(spark, cfg)["stg_trades"]
    plan = formatted_plan(staged.where("trade_date = DATE'2024-01-05' AND trader_id = 'TDR_001'"))
    assert "PartitionFilters: [isnotnull(trade_date" in plan
    assert "EqualTo(trader_id,TDR_001)" in plan and "Not(EqualTo(status,CANCELLED))" in plan


def test_fx_conversion_does_not_shuffle_trades(spark):
    """An instrument may hold a third of the trades: its rate goes to the trades instead."""
    (rates,) = shuffles(registry.queries()["fx_conversion"](spark, SMALL))
    assert rates.startswith("hashpartitioning(_fx_key")


def test_customers_are_broadcast_only_while_small(spark):
    """Above the threshold the growing dimension is shuffled, the fixed ones stay broadcast."""
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "1")
    try:
        plan = executed_plan(trades_view.trades(spark, SMALL))
    finally:
        spark.conf.set(key, before)
    assert "SortMergeJoin [user_id" in plan
    assert "BroadcastHashJoin [n_regionkey" in plan
