"""The jobs: ingest, Silver, Gold, quality gate, export, and all of them in order."""

from __future__ import annotations

import re
from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from blotter.config import GOLD_TABLES, Config
from blotter.operators import cleaning, profile, quality, validate
from blotter.operators.insert_only import PREFIX, new_rows, reachable
from blotter.operators.zorder import quantile_cuts
from blotter.plans import gold
from blotter.plans.silver import SILVER_DDL, silver
from blotter.session import prepare, sized_shuffles
from blotter.sinks import tables as sink
from blotter.sinks.csv_export import export
from blotter.sources import files
from blotter.sources.landing import parse, read_lines
from blotter.sources.tables import (
    SILVER_REQUIRED,
    read_gold,
    read_table,
    require_columns,
    table_exists,
)

SOURCE = "trades_jsonl"


BRONZE_SCHEMA = ", ".join([*(f"{name} string" for name in validate.FIELDS), "_ingested_at timestamp", "_source string"])


def fresh_rows(checked: DataFrame, target: DataFrame | None, at: Column) -> DataFrame:
    """The rows a load appends to Bronze: accepted, not there yet, with their lineage."""
    arrived = F.col("trade_timestamp").try_cast("timestamp")
    fresh = new_rows(validate.valid(checked), target, "trade_id", arrived)
    return fresh.withColumns({"_ingested_at": at, "_source": F.lit(SOURCE)})


def quarantine_rows(checked: DataFrame, at: Column) -> DataFrame:
    """The rows a load adds to the quarantine: rejected, with reasons, time and load."""
    return validate.quarantined(checked).withColumn("_quarantined_at", at)


def _replace_quarantine(spark: SparkSession, checked: DataFrame, quarantined: int, cfg: Config) -> None:
    """Make the quarantine hold, of the loads at hand, just what is rejected now."""
    path = cfg.quarantine_path
    if table_exists(spark, path, cfg):
        # Loads that had rejected lines before and have none any more.
        clean = checked.groupBy(sink.LOAD).agg(F.count_if(~F.col(validate.VALID)).alias("bad"))
        before = read_table(spark, path, cfg).select(sink.LOAD).distinct()
        mended = clean.where(F.col("bad") == 0).join(before, sink.LOAD, "left_semi")
        sink.clear_loads(spark, path, [row[sink.LOAD] for row in mended.collect()])
    if quarantined:
        sink.write_loads(quarantine_rows(checked, F.current_timestamp()), path, cfg)


def _bronze_schema(cfg: Config) -> str:
    return BRONZE_SCHEMA + (f", {PREFIX} string" if cfg.bronze_digits else "")


def bronze_for(spark: SparkSession, cfg: Config, batch: DataFrame) -> DataFrame | None:
    """As much of Bronze as has to be read to insert the batch."""
    if not cfg.bronze_digits or not table_exists(spark, cfg.bronze_path, cfg):
        return bronze(spark, cfg)
    table = read_table(spark, cfg.bronze_path, cfg, _bronze_schema(cfg))
    return reachable(table, validate.valid(batch), "trade_id", cfg.bronze_digits).drop(PREFIX)


def bronze(spark: SparkSession, cfg: Config) -> DataFrame | None:
    """Bronze as it is, or None before the first load."""
    if cfg.bronze_table is not None:
        return spark.table(cfg.bronze_table) if spark.catalog.tableExists(cfg.bronze_table) else None
    if not table_exists(spark, cfg.bronze_path, cfg):
        return None
    return read_table(spark, cfg.bronze_path, cfg, _bronze_schema(cfg)).drop(PREFIX)


def ingest_lines(lines: DataFrame, cfg: Config) -> dict:
    """Validate landing lines, quarantine the bad ones, insert the new good ones into Bronze.

    `lines` has the lines (`value`) and the load of each (`_load_id`). They are parsed once into
    shared staging, which both branches then read. Running a load again changes nothing: Bronze
    takes a trade_id once, and of a load the quarantine holds what is rejected now.
    """
    spark = prepare(lines.sparkSession)
    checked = validate.check(parse(lines))
    # The raw line is only kept where it is needed, with a rejected record.
    raw_if_bad = F.when(~F.col(validate.VALID), F.col(validate.RAW))
    totals = {
        "valid": F.count_if(validate.VALID), "quarantined": F.count_if(~F.col(validate.VALID)),
    }
    with sink.staged(checked.withColumn(validate.RAW, raw_if_bad), cfg, totals) as (rows, counts):
        _replace_quarantine(spark, rows, counts["quarantined"], cfg)
        inserted = 0
        if counts["valid"]:
            fresh = fresh_rows(rows, bronze_for(spark, cfg, rows), F.current_timestamp())
            inserted = sink.append_bronze(fresh, cfg)
    return {
        "valid_count": counts["valid"],
        "quarantine_count": counts["quarantined"],
        "inserted_count": inserted,
    }


def load_name(load_id: str) -> str:
    """A load id that can name a folder."""
    if not re.fullmatch(r"[\w.-]+", load_id):
        raise ValueError(f"a load id has letters, digits, '_', '.' and '-' only: {load_id!r}")
    return load_id


def ingest(spark: SparkSession, path: str, cfg: Config, load_id: str | None = None) -> dict:
    """Ingest landing files. Give a load its own id to make a re-run replace its quarantine."""
    lines = read_lines(spark, path).withColumn(sink.LOAD, F.lit(load_name(load_id or uuid4().hex)))
    stored = files.stored_bytes(spark, path, cfg.bronze_path)
    with sized_shuffles(spark, stored, cfg.partition_bytes):
        return ingest_lines(lines, cfg)


def silver_cuts(rows: DataFrame) -> dict[str, list]:
    """Quantiles of Silver's clustering columns, from Bronze: those columns are only cleaned."""
    kept = cleaning.drop_cancelled(cleaning.clean(rows))
    return {name: quantile_cuts(kept, name) for name in sink.SILVER_ZORDER}


def transform(
    spark: SparkSession,
    cfg: Config,
    rates: DataFrame | None = None,
    bronze_path: str | None = None,
    silver_path: str | None = None,
) -> dict:
    """Bronze to Silver. Returns the rows written; `report` tells what was left out and why."""
    prepare(spark)
    source = bronze_path or cfg.bronze_path
    if cfg.bronze_table is not None and bronze_path is None:
        rows = spark.table(cfg.bronze_table)
    else:
        rows = read_table(spark, source, cfg, BRONZE_SCHEMA)  # without the partition, if there is one
    with sized_shuffles(spark, files.stored_bytes(spark, source), cfg.partition_bytes):
        cuts = silver_cuts(rows) if cfg.cluster_silver and cfg.zorder_silver else None
        finished = silver(rows, cfg, rates)
        written = sink.write_silver(finished, silver_path or cfg.silver_path, cfg, cuts)
    if cfg.gold_database and silver_path is None:
        sink.register_path(
            spark, cfg.silver_path, cfg.gold_database, "silver_trades", SILVER_DDL, cfg
        )
    return {"silver": written}


def gold_inputs(spark: SparkSession, cfg: Config) -> dict[str, DataFrame]:
    """The staging and enrichment views over the Silver table, also registered for SQL."""
    source = require_columns(read_table(spark, cfg.silver_path, cfg, SILVER_DDL), SILVER_REQUIRED)
    staged = sink.as_view(gold.staging(source), "stg_trades")
    full = sink.as_view(gold.enriched(staged, cfg), "int_trade_enriched")
    return {"stg_trades": staged, "int_trade_enriched": full}


def build_gold(spark: SparkSession, cfg: Config) -> dict[str, int]:
    """Read Silver once into the activity cube and roll it up into every mart."""
    prepare(spark)
    with sized_shuffles(spark, files.stored_bytes(spark, cfg.silver_path), cfg.partition_bytes):
        cube = gold.activity_cube(gold_inputs(spark, cfg)["int_trade_enriched"])
        with sink.staged(cube, cfg) as (cells, _):
            return {
                table: sink.write_gold(gold.MARTS[table](cells, cfg), table, cfg)
                for table in GOLD_TABLES
            }


def quality_inputs(spark: SparkSession, cfg: Config) -> dict[str, DataFrame]:
    """Every table the quality rules are about, by name."""
    return gold_inputs(spark, cfg) | {t: read_gold(spark, t, cfg) for t in GOLD_TABLES}


def check_quality(spark: SparkSession, cfg: Config) -> list[dict]:
    """Run every rule over the views and marts; raises if a blocking one fails."""
    prepare(spark)
    with sized_shuffles(spark, files.stored_bytes(spark, cfg.silver_path), cfg.partition_bytes):
        suite = quality.run_suite(quality_inputs(spark, cfg), same_rows=quality.SAME_ROWS)
        return quality.enforce(suite)


def report(spark: SparkSession, cfg: Config) -> dict[str, DataFrame]:
    """What to look at after a run, as DataFrames to show or store."""
    loaded = bronze(spark, cfg)
    trades = read_table(spark, cfg.silver_path, cfg, SILVER_DDL)
    marts = {t: read_gold(spark, t, cfg) for t in GOLD_TABLES}
    return {
        "bronze_status": profile.breakdown(loaded, "status"),
        "silver_summary": profile.silver_summary(trades),
        "silver_days": profile.breakdown(trades, "trade_date"),
        "alert_levels": profile.breakdown(trades, "alert_level"),
        "risk_tiers": profile.breakdown(trades, "risk_tier"),
        "flagged_traders": profile.flagged_traders(trades),
        "layers": profile.reconciliation(
            cleaning.intake(loaded), profile.table_counts({"silver": trades, **marts})
        ),
    }


def run_pipeline(
    spark: SparkSession, cfg: Config, input_path: str, load_id: str | None = None
) -> dict:
    """Ingest, Silver, Gold, quality gate, export. A failed step stops the later ones."""
    prepare(spark)
    return {
        "ingest": ingest(spark, input_path, cfg, load_id),
        "silver": transform(spark, cfg),
        "gold": build_gold(spark, cfg),
        "quality": check_quality(spark, cfg),
        "export": export(spark, f"{cfg.root}/export", cfg),
    }
