"""Exact distinct counts that merge: values become dense numbers, and sets of them bitmaps.

A bitmap holds 32,768 numbers in 4 KB; larger numbers go to further ones. Bitmaps are combined with OR in
the map tasks, so what is shuffled does not grow with the rows, and the bitmaps of parts of a
table, such as its days, combine to those of the whole without its rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from blotter.operators.ranking import places
from blotter.session import checkpointed


def numbered(values: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """`value` and `number` for the values of a one-column table that `known` doesn't have yet.

    Numbers go on after those of `known`, which keep theirs. An unknown value has no number.
    """
    value = F.col(values.columns[0]).alias("value")
    fresh = values.select(value).where(F.col("value").isNotNull()).distinct()
    last = 0
    if known is not None:
        fresh = fresh.join(known.select("value"), "value", "left_anti")
        last = known.agg(F.max("number")).first()[0] or 0
    placed = places(checkpointed(fresh), F.col("value"), [])
    return placed.select(F.col("_key").alias("value"), (F.col("_place") + last).alias("number"))


def sets(rows: DataFrame, keys: Sequence[str], number: str = "number") -> DataFrame:
    """Per group the set of its numbers: rows of the keys, `bucket` and `bits`."""
    return (
        rows.where(F.col(number).isNotNull())
        .groupBy(*keys, F.bitmap_bucket_number(number).alias("bucket"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position(number)).alias("bits"))
    )


def united(parts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The sets of coarser groups."""
    return parts.groupBy(*keys, "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))


def sizes(parts: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    """How many different values each group has, over all of its parts."""
    whole = united(parts, keys)
    return whole.groupBy(*keys).agg(F.sum(F.bitmap_count("bits")).alias(name))
