"""Breakdowns, summaries and reconciliation of tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def sample_rows(df: DataFrame, n: int, *columns: str) -> DataFrame:
    """Any `n` rows to look at, of all or of some columns."""
    return (df.select(*columns) if columns else df).limit(n)


def breakdown(df: DataFrame, column: str) -> DataFrame:
    """Rows per value of a column, in order of the value."""
    return df.groupBy(column).count().orderBy(column)


def flagged_traders(trades: DataFrame, n: int = 10) -> DataFrame:
    """The traders with most velocity-flagged trades; equal counts in order of the trader."""
    return (
        trades.where("velocity_flag")
        .groupBy("trader_id")
        .agg(F.count("trade_id").alias("flagged_trades"))
        .orderBy(F.col("flagged_trades").desc(), "trader_id")
        .limit(n)
    )


def silver_summary(trades: DataFrame) -> DataFrame:
    """One row: rows, date range, distinct traders and instruments.

    Rows are first combined per trader and instrument, so the exact distinct counts run over
    those pairs and not over the trades.
    """
    pairs = trades.groupBy("trader_id", "instrument").agg(
        F.count(F.lit(1)).alias("n"),
        F.min("trade_date").alias("first"),
        F.max("trade_date").alias("last"),
    )
    return pairs.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_rows"),
        F.min("first").alias("first_date"),
        F.max("last").alias("last_date"),
        F.count_distinct("trader_id").alias("traders"),
        F.count_distinct("instrument").alias("instruments"),
    )


def _as_rows(counts: DataFrame) -> DataFrame:
    """One row with a count per column to one row (layer, n_rows) per count."""
    pairs = ", ".join(f"'{name}', `{name}`" for name in counts.columns)
    return counts.selectExpr(f"stack({len(counts.columns)}, {pairs}) AS (layer, n_rows)")


def table_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """The rows (layer, n_rows) of tables that exist."""
    one_each = [
        df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(layer).alias("layer"), "n_rows")
        for layer, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, one_each)


def cube_counts(cube: DataFrame, grains: Mapping[str, Sequence[str]]) -> DataFrame:
    """The rows (layer, n_rows) Silver has and the marts will have, from the cube alone."""
    return _as_rows(
        cube.agg(
            F.coalesce(F.sum("trades"), F.lit(0)).alias("silver"),
            *[F.count_distinct(F.struct(*grain)).alias(mart) for mart, grain in grains.items()],
        )
    )


def reconciliation(intake: DataFrame, counts: DataFrame) -> DataFrame:
    """Rows per layer, with the rows that Silver left out by their reason.

    `intake` is the one-row result of `cleaning.intake`, `counts` comes from one of the two above.
    """
    return _as_rows(intake).unionByName(counts)
