"""Export of the marts as CSV."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from uuid import uuid4

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession

from blotter.config import GOLD_TABLES, Config
from blotter.plans.gold import READING_ORDER, in_reading_order
from blotter.sinks.tables import counting
from blotter.sources import files
from blotter.sources.tables import read_gold


@dataclass(frozen=True)
class Exported:
    """What became of one table: its rows in `path`, or the error that kept it from there."""

    table: str
    path: str
    rows: int | None = None
    error: str | None = None


class ExportError(RuntimeError):
    """Some tables could not be exported; `results` tells which, and what the others gave."""

    def __init__(self, results: list[Exported]) -> None:
        self.results = results
        super().__init__("; ".join(f"{r.table}: {r.error}" for r in results if r.error))


def write_csv(df: DataFrame, path: str) -> int:
    """CSV parts with a header; returns the rows, counted while they are written."""
    with counting(df) as (counted, counts):
        counted.write.mode("overwrite").options(header=True, encoding="UTF-8").csv(path)
    return counts["rows"]


def export_table(
    spark: SparkSession, table: str, output_dir: str, cfg: Config, one_part: bool = False
) -> Exported:
    """One mart in reading order: a folder of parts whose names follow the order, or one file.

    The parts are sorted by all tasks. With `one_part` the table is `<table>.csv`, which one task
    writes, so it is for the caller to ask for, of a mart known to be small. It is written beside
    its place and moved there when it is whole.
    """
    path = f"{output_dir}/{table}"
    try:
        mart = read_gold(spark, table, cfg)
        if not one_part:
            return Exported(table, path, rows=write_csv(in_reading_order(mart, table), path))
        beside = f"{path}.{uuid4().hex}"
        ordered = mart.coalesce(1).sortWithinPartitions(*READING_ORDER[table]())
        rows = write_csv(ordered, beside)
        files.publish_part(spark, beside, f"{path}.csv")
        return Exported(table, f"{path}.csv", rows=rows)
    except (PySparkException, OSError) as error:
        return Exported(table, path, error=str(error))


def export(
    spark: SparkSession,
    output_dir: str,
    cfg: Config,
    tables: Iterable[str] = GOLD_TABLES,
    one_part: bool = False,
) -> list[Exported]:
    """Every table; a table that fails does not keep the others from being written."""
    results = [export_table(spark, table, output_dir, cfg, one_part) for table in tables]
    if any(result.error for result in results):
        raise ExportError(results)
    return results
