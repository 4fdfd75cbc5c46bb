"""Order statistics over a whole table without gathering it in one task.

The rows' keys are range-partitioned and sorted once per order. A row's place is its place within its
partition plus the rows of the partitions before, and those are one short row per partition. Keys
that tie share the smallest of their places, which makes it a rank.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from blotter.session import checkpointed

# monotonically_increasing_id() has the partition above these bits and the row below them.
_ROW_BITS = 33


def descending(value: Column) -> Column:
    """A number as an ascending key: the largest first, unknown last."""
    return F.struct(value.isNull(), -value)


def places(rows: DataFrame, key: Column, grain: Sequence[str]) -> DataFrame:
    """`_key`, the grain and `_place`: 1, 2, ... by the key and then by the grain.

    `rows` is read twice, for the ranges and for the rows, so it should be a stored table. The
    grain splits ties: very many rows of one key end up in several partitions.
    """
    order = ["_key", *grain]
    sorted_rows = checkpointed(
        rows.select(key.alias("_key"), *grain)
        .repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_at", F.monotonically_increasing_id())
    )
    part = F.shiftright("_at", _ROW_BITS).alias("_part")
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sorted_rows.groupBy(part).agg(F.count(F.lit(1)).alias("n"))
    # As many rows as there are partitions.
    offsets = sizes.select("_part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_before"))
    row = F.col("_at").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    placed = sorted_rows.select("*", part).join(F.broadcast(offsets), "_part")
    return placed.select(*order, (F.col("_before") + row + 1).alias("_place"))


def with_ranks(rows: DataFrame, orders: Mapping[str, Column], grain: Sequence[str]) -> DataFrame:
    """Add a rank per order (its name and ascending key); equal keys share a rank.

    `rows` is a stored table that serves every order. Only keys and grain are sorted.
    """
    ranked = rows
    for name, key in orders.items():
        first = places(rows, key, grain).groupBy("_key").agg(F.min("_place").cast("int").alias(name))
        joined = ranked.withColumn("_own", key).join(first, F.col("_own").eqNullSafe(F.col("_key")))
        ranked = joined.drop("_own", "_key")
    return ranked


def with_place(rows: DataFrame, key: Column, name: str, grain: Sequence[str]) -> DataFrame:
    """Add each row's place in the order of an ascending key, from 1 on.

    `rows` is a stored table, and the grain tells its rows apart.
    """
    own = [F.col(column).alias(f"_{column}") for column in grain]
    placed = places(rows, key, grain).select(*own, F.col("_place").cast("int").alias(name))
    same = [F.col(column).eqNullSafe(F.col(f"_{column}")) for column in grain]
    return rows.join(placed, same).drop(*[f"_{column}" for column in grain])
