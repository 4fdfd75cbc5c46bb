"""Writing tables. Every write reports its row count without reading the table back."""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Mapping, Sequence
from contextlib import contextmanager
from uuid import uuid4

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from blotter.config import Config
from blotter.operators.insert_only import PREFIX, prefix
from blotter.operators.validate import LOAD
from blotter.operators.zorder import clustered
from blotter.sources import files

# Rows of one day that lie close together: file and row-group statistics then skip on traders
# and instruments. The last two columns let a range cut even inside one trader's instrument.
SILVER_LAYOUT = ("trade_date", "trader_id", "instrument", "trade_timestamp", "trade_id")
# The columns a space-filling key runs through, for filters on any of them.
SILVER_ZORDER = ("trader_id", "instrument")


@contextmanager
def counting(
    df: DataFrame, more: Mapping[str, Column] | None = None
) -> Iterator[tuple[DataFrame, dict]]:
    """Count the rows of a write, and compute other aggregates of them, while it runs.

    The counter sits on top of the plan, in the stage that writes, so no other job over the
    same plan (a sampling pass, a second branch) runs through it.
    """
    observation = Observation(f"rows_{uuid4().hex}")
    counts: dict = {}
    wanted = {"rows": F.count(F.lit(1))} | dict(more or {})
    yield df.observe(observation, *[value.alias(name) for name, value in wanted.items()]), counts
    counts.update(observation.get)


def append(df: DataFrame, path: str, cfg: Config) -> int:
    with counting(df) as (counted, counts):
        counted.write.format(cfg.table_format).mode("append").save(path)
    return counts["rows"]


def append_bronze(df: DataFrame, cfg: Config) -> int:
    """Append to Bronze: its folder, perhaps partitioned by its ids, or its catalog table bucketed by
    trade_id.
    """
    if cfg.bronze_digits:
        placed = df.withColumn(PREFIX, prefix(F.col("trade_id"), cfg.bronze_digits))
        with counting(placed.hint("rebalance", PREFIX)) as (counted, counts):
            counted.write.format(cfg.table_format).mode("append").partitionBy(PREFIX).save(cfg.bronze_path)
        return counts["rows"]
    if cfg.bronze_table is None:
        return append(df, cfg.bronze_path, cfg)
    with counting(df) as (counted, counts):
        (
            counted.write.format(cfg.table_format)
            .mode("append")
            .bucketBy(cfg.bronze_buckets, "trade_id")
            .sortBy("trade_id")
            .saveAsTable(cfg.bronze_table)
        )
    return counts["rows"]


def overwrite(df: DataFrame, path: str, cfg: Config, partition_by: Sequence[str] = ()) -> int:
    """Replace a table. The new one is written beside it and moved into place when it is whole."""
    beside = f"{path.rstrip('/')}.{uuid4().hex}"
    spark = df.sparkSession
    try:
        with counting(df) as (counted, counts):
            counted.write.format(cfg.table_format).partitionBy(*partition_by).save(beside)
    except BaseException:
        files.delete(spark, beside)
        raise
    files.replace(spark, beside, path)
    return counts["rows"]


def write_loads(df: DataFrame, path: str, cfg: Config) -> int:
    """Write the rows of some loads, each its own partition; writing a load again replaces it."""
    with counting(df) as (counted, counts):
        (
            counted.write.format(cfg.table_format)
            .mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(LOAD)
            .save(path)
        )
    return counts["rows"]


def clear_loads(spark: SparkSession, path: str, load_ids: Iterable[str]) -> None:
    """Remove what earlier runs of these loads have written."""
    for load_id in load_ids:
        files.delete(spark, f"{path}/{LOAD}={load_id}")


def write_silver(
    df: DataFrame, path: str, cfg: Config, cuts: Mapping[str, Sequence] | None = None
) -> int:
    """Replace Silver: partitioned by date, clustered by trader and instrument within a date.

    With `cuts`, the quantiles of both, a file and a row group hold a narrow range of each. Without,
    the rows are sorted by trader and then instrument. Not clustered, adaptive execution
    balances the rows of a date over files, splitting a hot date.
    """
    if cfg.cluster_silver and cuts is not None:
        placed = clustered(df, "trade_date", cuts, SILVER_LAYOUT[1:])
    elif cfg.cluster_silver:
        placed = df.repartitionByRange(*SILVER_LAYOUT).sortWithinPartitions(*SILVER_LAYOUT)
    else:
        placed = df.hint("rebalance", "trade_date").sortWithinPartitions(*SILVER_LAYOUT)
    return overwrite(placed, path, cfg, ["trade_date"])


def replace_dates(df: DataFrame, path: str, cfg: Config) -> int:
    """Write the dates that the rows have anew; other dates keep their files."""
    with counting(df.hint("rebalance", "trade_date")) as (counted, counts):
        (
            counted.write.format(cfg.table_format)
            .mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("trade_date")
            .save(path)
        )
    return counts["rows"]


def write_gold(df: DataFrame, table: str, cfg: Config) -> int:
    """Replace a mart, in the catalog or under the lake's root, once the new one is whole."""
    if not cfg.gold_database:
        return overwrite(df, cfg.gold_path(table), cfg)
    spark = df.sparkSession
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {cfg.gold_database}")
    name = f"{cfg.gold_database}.{table}"
    beside = f"{name}__{uuid4().hex}"
    with counting(df) as (counted, counts):
        counted.write.format(cfg.table_format).saveAsTable(beside)
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.sql(f"ALTER TABLE {beside} RENAME TO {name}")
    return counts["rows"]


def register_path(
    spark: SparkSession, path: str, database: str, table: str, schema: str, cfg: Config
) -> str:
    """Make a table that lies in a folder, partitioned by date, known to the catalog."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    name = f"{database}.{table}"
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.sql(
        f"CREATE TABLE {name} ({schema}) USING {cfg.table_format} "
        f"PARTITIONED BY (trade_date) LOCATION '{path}'"
    )
    spark.catalog.recoverPartitions(name)
    return name


def register(df: DataFrame, database: str, table: str, cfg: Config) -> str:
    """Save a DataFrame as a managed catalog table."""
    df.sparkSession.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    name = f"{database}.{table}"
    df.write.format(cfg.table_format).mode("overwrite").saveAsTable(name)
    return name


def as_view(df: DataFrame, name: str) -> DataFrame:
    """Expose a DataFrame to SQL under a name; nothing is computed."""
    df.createOrReplaceTempView(name)
    return df


def _shared_folder(spark: SparkSession, cfg: Config) -> str:
    """Where executors may all read and write: the cluster's checkpoint folder, else the lake."""
    return spark.conf.get("spark.checkpoint.dir", None) or f"{cfg.root}/_staging"


@contextmanager
def staged(
    df: DataFrame, cfg: Config, counts: Mapping[str, Column] | None = None
) -> Iterator[tuple[DataFrame, dict]]:
    """Write a DataFrame once to shared storage for several readers, and remove it afterwards.

    Unlike a cache it survives lost executors, and readers load only the columns they need. What
    the write counted comes with it.
    """
    spark = df.sparkSession
    path = f"{_shared_folder(spark, cfg)}/blotter/{uuid4().hex}"
    try:
        with counting(df, counts) as (counted, found):
            counted.write.parquet(path)
        yield spark.read.schema(df.schema).parquet(path), found
    finally:
        files.delete(spark, path)
