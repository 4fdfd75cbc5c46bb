"""Idempotent insertion by key: rows already in the target, and repeats in a batch, add nothing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


PREFIX = "_prefix"


def prefix(key: Column, digits: int) -> Column:
    """The partition of a key: the first hex digits of its MD5, which spread any keys evenly."""
    return F.left(F.md5(key.cast("binary")), F.lit(digits))


def prefixes_of(batch: DataFrame, key: str, digits: int) -> list[str]:
    """The partitions the keys of a batch fall in: at most 16**digits."""
    found = batch.where(F.col(key).isNotNull()).select(prefix(F.col(key), digits).alias(PREFIX)).distinct()
    return sorted(row[PREFIX] for row in found.collect())


def reachable(target: DataFrame, batch: DataFrame, key: str, digits: int) -> DataFrame:
    """The part of a target, partitioned by PREFIX, that may have keys of the batch."""
    return target.where(F.col(PREFIX).isin(prefixes_of(batch, key, digits)))


def first_copies(batch: DataFrame, key: str, earliest: Column) -> DataFrame:
    """One row per key: the earliest, then the smallest by its columns, so always the same one.

    Spark keeps the first row of each key in every map task before the shuffle (a partial
    window group limit), so a key with very many copies does not end up in one task.
    """
    others = [name for name in batch.columns if name != key]
    by_age = Window.partitionBy(key).orderBy(earliest.asc_nulls_last(), *others)
    numbered = batch.withColumn("_copy", F.row_number().over(by_age))
    return numbered.where(F.col("_copy") == 1).drop("_copy")


def new_rows(
    batch: DataFrame, target: DataFrame | None, key: str, earliest: Column
) -> DataFrame:
    """The rows to append to `target` so that it holds every key of the batch once.

    The target is the large side, so it never meets the batch as a whole. It is first cut
    down to the keys of the batch: a semi join whose small side Spark broadcasts, or turns
    into a runtime filter, when it is small enough.
    """
    unique = first_copies(batch, key, earliest)
    if target is None:
        return unique
    known = target.select(key).join(batch.select(key).distinct(), key, "left_semi")
    return unique.join(known, key, "left_anti")
