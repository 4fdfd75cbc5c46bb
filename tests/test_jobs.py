"""The jobs end to end in a temporary lake."""

from __future__ import annotations

import csv
from dataclasses import replace
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from blotter.operators import quality
from blotter.plans import gold, jobs
from blotter.plans.silver import silver
from blotter.session import sized_shuffles
from blotter.sinks import tables as sink
from blotter.sinks.csv_export import ExportError, export
from blotter.sources import files
from blotter.sources.tables import (
    ContractError,
    read_gold,
    read_path_sql,
    read_table,
    require_columns,
    table_exists,
)
from tests.conftest import line
from tests.plans import executed_plan

GOOD_LINES = [
    line(trade_id="a", instrument="GBPUSD", desk="FX", notional=2_000_000),
    line(trade_id="b", direction="SELL", trader_id="TDR_002", trade_timestamp="2026-01-06T12:00:00"),
    line(trade_id="c", status="CANCELLED"),
    line(trade_id="d", status="PENDING", trader_id="TDR_003"),
]
BAD_LINES = [line(trade_id="x", notional=-1), "{oops"]


@pytest.fixture
def landing(tmp_path):
    def write(*lines, name="trades.jsonl"):
        path = tmp_path / "landing" / name
        path.parent.mkdir(exist_ok=True)
        path.write_text("\n".join(lines) + "\n")
        return str(path)

    return write


def test_ingest_counts_and_tables(spark, cfg, landing):
    path = landing(*GOOD_LINES, *BAD_LINES, GOOD_LINES[0])
    assert not table_exists(spark, cfg.bronze_path, cfg)
    assert jobs.ingest(spark, path, cfg) == {
        "valid_count": 5, "quarantine_count": 2, "inserted_count": 4,
    }
    assert table_exists(spark, cfg.bronze_path, cfg)
    bronze = read_table(spark, cfg.bronze_path, cfg)
    assert sorted(r.trade_id for r in bronze.collect()) == ["a", "b", "c", "d"]
    assert {r._source for r in bronze.collect()} == {"trades_jsonl"}
    assert bronze.where("_ingested_at IS NULL").count() == 0
    bad = read_table(spark, cfg.quarantine_path, cfg)
    assert {r._error for r in bad.collect()} == {"notional: not positive", "malformed_json"}
    assert {r._raw for r in bad.collect()} == set(BAD_LINES)
    assert bad.where("_quarantined_at IS NULL").count() == 0
    assert read_path_sql(spark, cfg.bronze_path, cfg).count() == 4


def test_ingest_again_adds_only_what_is_new(spark, cfg, landing):
    jobs.ingest(spark, landing(*GOOD_LINES, *BAD_LINES), cfg, "load-1")
    again = jobs.ingest(spark, landing(*GOOD_LINES, *BAD_LINES), cfg, "load-1")
    assert again["inserted_count"] == 0
    assert read_table(spark, cfg.quarantine_path, cfg).count() == 2
    more = jobs.ingest(spark, landing(GOOD_LINES[0], line(trade_id="e")), cfg, "load-2")
    assert more == {"valid_count": 2, "quarantine_count": 0, "inserted_count": 1}
    assert read_table(spark, cfg.bronze_path, cfg).count() == 5
    jobs.ingest(spark, landing(*BAD_LINES), cfg, "load-3")
    assert read_table(spark, cfg.quarantine_path, cfg).count() == 4


def test_ingest_of_bad_lines_only_writes_no_bronze(spark, cfg, landing):
    result = jobs.ingest(spark, landing(*BAD_LINES), cfg)
    assert result == {"valid_count": 0, "quarantine_count": 2, "inserted_count": 0}
    assert not table_exists(spark, cfg.bronze_path, cfg)


def test_an_empty_folder_is_no_table(spark, cfg):
    Path(cfg.bronze_path).mkdir(parents=True)
    assert not table_exists(spark, cfg.bronze_path, cfg)


def test_staging_is_removed(spark, cfg, landing):
    shared = Path(sink._shared_folder(spark, cfg).removeprefix("file:")) / "blotter"
    before = set(shared.glob("*"))
    jobs.ingest(spark, landing(*GOOD_LINES), cfg)
    assert set(shared.glob("*")) <= before


def test_a_mended_load_leaves_the_quarantine(spark, cfg, landing):
    jobs.ingest(spark, landing(*BAD_LINES), cfg, "load-1")
    jobs.ingest(spark, landing(*BAD_LINES[:1], name="other.jsonl"), cfg, "load-2")
    again = jobs.ingest(spark, landing(line(trade_id="x")), cfg, "load-1")
    assert again == {"valid_count": 1, "quarantine_count": 0, "inserted_count": 1}
    left = read_table(spark, cfg.quarantine_path, cfg).collect()
    assert [(r._load_id, r._raw) for r in left] == [("load-2", BAD_LINES[0])]


def test_a_load_id_names_a_folder(spark, cfg, landing):
    with pytest.raises(ValueError, match="a load id"):
        jobs.ingest(spark, landing(*GOOD_LINES), cfg, "../elsewhere")


def test_bronze_as_a_bucketed_table(spark, cfg, landing):
    cfg = replace(cfg, bronze_table="bronze_job_test", bronze_buckets=4)
    try:
        assert jobs.bronze(spark, cfg) is None
        assert jobs.ingest(spark, landing(*GOOD_LINES), cfg)["inserted_count"] == 4
        assert jobs.ingest(spark, landing(*GOOD_LINES, line(trade_id="e")), cfg)["inserted_count"] == 1
        assert jobs.transform(spark, cfg) == {"silver": 4}
    finally:
        spark.sql("DROP TABLE IF EXISTS bronze_job_test")


def test_all_cancelled_runs_through(spark, cfg, landing):
    path = landing(line(trade_id="c", status="CANCELLED"))
    result = jobs.run_pipeline(spark, cfg, path)
    assert result["silver"] == {"silver": 0}
    assert result["gold"] == dict.fromkeys(gold.MARTS, 0)


def test_a_failing_write_keeps_the_old_table(spark, cfg, landing):
    jobs.ingest(spark, landing(*GOOD_LINES), cfg)
    jobs.transform(spark, cfg)
    jobs.build_gold(spark, cfg)
    silver = read_table(spark, cfg.silver_path, cfg)
    broken = silver.withColumn(
        "counterparty", F.when(F.col("trade_id") == "b", F.raise_error(F.lit("no"))).otherwise("x")
    )
    marts = {t: read_gold(spark, t, cfg).collect() for t in gold.MARTS}
    with pytest.raises(Exception, match="no"):
        sink.write_silver(broken, cfg.silver_path, cfg)
    with pytest.raises(Exception, match="no"):
        sink.overwrite(broken, cfg.gold_path("mart_daily_volume"), cfg)
    assert read_table(spark, cfg.silver_path, cfg).count() == 3
    assert {t: read_gold(spark, t, cfg).collect() for t in gold.MARTS} == marts
    assert sorted(p.name for p in (Path(cfg.root) / "gold").iterdir()) == sorted(gold.MARTS)


def test_silver_reads_bronze_without_counting_it(spark, cfg, landing):
    """Planned for the rows and for the sums per segment, each with the sample for the cuts."""
    jobs.ingest(spark, landing(*GOOD_LINES), cfg)
    plan = executed_plan(silver(jobs.bronze(spark, cfg), cfg))
    assert plan.count("FileScan parquet") <= 4


def test_silver_job_counts_and_layout(spark, cfg, landing):
    jobs.ingest(spark, landing(*GOOD_LINES), cfg)
    assert jobs.transform(spark, cfg) == {"silver": 3}
    days = {p.name for p in Path(cfg.silver_path).iterdir() if p.is_dir()}
    assert days == {"trade_date=2026-01-05", "trade_date=2026-01-06"}
    assert jobs.transform(spark, cfg)["silver"] == 3
    assert read_table(spark, cfg.silver_path, cfg).count() == 3
    other = f"{cfg.root}/elsewhere"
    balanced = replace(cfg, cluster_silver=False)
    assert jobs.transform(spark, balanced, silver_path=other)["silver"] == 3
    assert read_table(spark, other, cfg).count() == 3


def test_clustered_files_hold_few_traders(spark, cfg, landing):
    """A trader's rows lie in few files, and a hot trader's rows in several."""
    lines = [
        line(
            trade_id=f"t{i:04d}",
            trader_id="TDR_000" if i % 3 == 0 else f"TDR_{i % 40 + 1:03d}",
            trade_timestamp=f"2026-01-05T09:{i // 60 % 60:02d}:{i % 60:02d}",
        )
        for i in range(900)
    ]
    jobs.ingest(spark, landing(*lines), cfg)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        jobs.transform(spark, cfg)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    rows = read_table(spark, cfg.silver_path, cfg).selectExpr(
        "trader_id", "input_file_name() AS file"
    ).collect()
    files_of = {}
    for r in rows:
        files_of.setdefault(r.trader_id, set()).add(r.file)
    assert len({r.file for r in rows}) == 8
    assert len(files_of["TDR_000"]) >= 2
    assert all(len(f) <= 2 for trader, f in files_of.items() if trader != "TDR_000")


def test_pipeline(spark, cfg, landing):
    path = landing(*GOOD_LINES, *BAD_LINES)
    result = jobs.run_pipeline(spark, cfg, path, "load-1")
    assert result["silver"]["silver"] == 3
    assert result["gold"] == {
        "mart_daily_volume": 3, "mart_risk_exposure": 3, "mart_top_instruments": 2,
    }
    assert len(result["quality"]) == 51
    assert {e.table: e.rows for e in result["export"]} == result["gold"]
    for table, rows in result["gold"].items():
        read = exported(f"{cfg.root}/export/{table}")
        assert len(read) == rows
        assert set(read[0]) == set(read_gold(spark, table, cfg).columns)
    assert [r["volume_rank"] for r in read] == ["1", "2"]
    # A second run changes nothing.
    again = jobs.run_pipeline(spark, cfg, path, "load-1")
    assert again["ingest"]["inserted_count"] == 0 and again["gold"] == result["gold"]

    report = jobs.report(spark, cfg)
    layers = {r.layer: r.n_rows for r in report["layers"].collect()}
    assert layers == {
        "bronze": 4, "dropped_incomplete": 0, "dropped_cancelled": 1, "dropped_no_status": 0,
        "silver": 3, **result["gold"],
    }
    assert report["silver_summary"].first().total_rows == 3
    assert [tuple(r) for r in report["alert_levels"].collect()] == [("NORMAL", 3)]
    assert [r["count"] for r in report["silver_days"].collect()] == [2, 1]
    assert report["flagged_traders"].count() == 0
    assert spark.table("int_trade_enriched").limit(2).count() == 2


def test_failing_rule_stops_before_the_export(spark, cfg, landing):
    path = landing(line(desk="Crypto"))
    with pytest.raises(quality.QualityError, match="accepted_values:stg_trades.desk"):
        jobs.run_pipeline(spark, cfg, path)
    assert not (Path(cfg.root) / "export").exists()


def test_gold_in_the_catalog(spark, cfg, landing):
    cfg = replace(cfg, gold_database="gold_test")
    jobs.ingest(spark, landing(*GOOD_LINES), cfg)
    jobs.transform(spark, cfg)
    jobs.build_gold(spark, cfg)
    assert spark.catalog.tableExists("gold_test.mart_daily_volume")
    assert read_gold(spark, "mart_daily_volume", cfg).count() == 3
    done = export(spark, f"{cfg.root}/export", cfg, ["mart_daily_volume"])
    assert [(e.table, e.rows) for e in done] == [("mart_daily_volume", 3)]
    assert spark.table("gold_test.silver_trades").count() == 3
    assert jobs.transform(spark, cfg) == {"silver": 3}
    assert spark.table("gold_test.silver_trades").where("trade_date = DATE'2026-01-06'").count() == 1
    rows = read_table(spark, cfg.silver_path, cfg)
    assert sink.register(rows, "gold_test", "copied_trades", cfg) == "gold_test.copied_trades"
    assert spark.table("gold_test.copied_trades").count() == 3
    spark.sql("DROP DATABASE gold_test CASCADE")


def test_export_reports_failures_after_exporting_the_rest(spark, cfg, landing):
    jobs.ingest(spark, landing(*GOOD_LINES), cfg)
    jobs.transform(spark, cfg)
    jobs.build_gold(spark, cfg)
    target = Path(cfg.root) / "export"
    files.delete(spark, cfg.gold_path("mart_daily_volume"))
    with pytest.raises(ExportError, match="mart_daily_volume") as failed:
        export(spark, str(target), cfg)
    assert [bool(r.error) for r in failed.value.results] == [True, False, False]
    assert (target / "mart_top_instruments").exists()


@pytest.mark.parametrize("one_part", [False, True])
def test_export_is_in_reading_order(spark, cfg, landing, one_part):
    lines = [line(trade_id=f"t{i}", trader_id=f"TDR_{i:03d}", notional=i + 1) for i in range(200)]
    jobs.ingest(spark, landing(*lines), cfg)
    jobs.transform(spark, cfg)
    jobs.build_gold(spark, cfg)
    (done,) = export(spark, f"{cfg.root}/export", cfg, ["mart_risk_exposure"], one_part)
    nets = [float(row["net_exposure_eur"]) for row in exported(done.path)]
    assert nets == sorted(nets, reverse=True) and len(nets) == done.rows == 200
    if one_part:
        assert done.path == f"{cfg.root}/export/mart_risk_exposure.csv" and Path(done.path).is_file()
        export(spark, f"{cfg.root}/export", cfg, ["mart_risk_exposure"], one_part)
        visible = [p.name for p in Path(cfg.root, "export").iterdir() if not p.name.startswith(".")]
        assert visible == ["mart_risk_exposure.csv"]


def exported(path):
    """The rows of all parts, in the order of their names, or of the one file."""
    parts = [Path(path)] if Path(path).is_file() else sorted(Path(path).glob("part-*.csv"))
    return [row for part in parts for row in csv.DictReader(part.open(encoding="utf-8"))]


def test_contract_check(spark):
    df = spark.createDataFrame([("a",)], "trade_id string")
    assert require_columns(df, ["trade_id"]) is df
    with pytest.raises(ContractError, match="region"):
        require_columns(df, ["trade_id", "region"])


def test_shuffle_sizing_only_raises_and_only_for_a_job(spark):
    key = "spark.sql.shuffle.partitions"
    before = spark.conf.get(key)
    for stored, wanted in ((100, int(before)), (100_000, 100), (10**9, 10**6)):
        with sized_shuffles(spark, stored, 1000) as count:
            assert count == wanted == int(spark.conf.get(key))
        assert spark.conf.get(key) == before
    with pytest.raises(KeyError), sized_shuffles(spark, 10**9, 1):
        raise KeyError
    assert spark.conf.get(key) == before


def test_stored_bytes(spark, tmp_path):
    (tmp_path / "a" / "b").mkdir(parents=True)
    (tmp_path / "a" / "b" / "x.txt").write_text("12345")
    (tmp_path / "a" / "y.txt").write_text("123")
    assert files.stored_bytes(spark, str(tmp_path / "a")) == 8
    assert files.stored_bytes(spark, str(tmp_path / "a" / "*.txt"), str(tmp_path / "none")) == 3


def test_every_mart_has_a_builder_and_an_order():
    assert set(gold.MARTS) == set(gold.READING_ORDER)
