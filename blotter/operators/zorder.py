"""Clustering by several columns at once along a space-filling key.

Every column's values are cut at quantiles into at most 2**BITS buckets. The bits of a row's buckets,
interleaved, are its key: rows that are close in the key are close in every column, so files and row
groups ordered by it hold a narrow range of each.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from blotter.operators.ranking import places
from blotter.session import checkpointed

# Buckets of a column, as bits.
BITS = 8
# A row finds its bucket in two steps, of this many cuts each at most.
_STEP = 1 << (BITS // 2)


def quantile_cuts(rows: DataFrame, column: str, bits: int = BITS) -> list:
    """The values at which the buckets 1, 2, ... begin, fewer than 2**bits - 1.

    Values are counted first, in the map tasks already, so a value of very many rows is one. The
    rows at or before a value come from the order of the counted values. A value with more
    rows than a bucket has one of its own. The smallest values and unknown ones are in bucket 0.
    """
    counted = checkpointed(
        rows.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("v")).agg(F.count(F.lit(1)).alias("n"))
    )
    buckets = 1 << bits
    total, distinct = counted.agg(F.sum("n"), F.count(F.lit(1))).first()
    if not distinct:
        return []
    if distinct < buckets:
        # Each its own bucket.
        return [row.v for row in counted.orderBy("v").collect()][1:]
    # Rows up to a value, by parts of the ordered values: within the part, and in those before.
    placed = places(counted, F.col("v"), []).select(F.col("_key").alias("v"), "_place").join(counted, "v")
    part = F.floor((F.col("_place") - 1) * buckets / distinct).alias("part")
    parts = placed.groupBy(part).agg(F.sum("n").alias("n"), F.min("v").alias("v")).orderBy("part").collect()
    cuts, so_far, last = [], 0, -1
    for row in parts:
        bucket = so_far * (buckets - 1) // total
        if bucket > last:
            cuts.append(row.v)
            last = bucket
        so_far += row.n
    return cuts[1:]


def bucket_of(value: Column, cuts: Sequence) -> Column:
    """How many cuts are at or before a value. The cuts are a literal, searched in two steps."""
    if not cuts:
        return F.lit(0)
    blocks = [cuts[at : at + _STEP] for at in range(0, len(cuts), _STEP)]
    heads = F.array(*[F.lit(block[0]) for block in blocks])
    inner = F.array(*[F.array(*map(F.lit, block)) for block in blocks])
    up_to = lambda items: F.size(F.filter(items, lambda cut: cut <= value))
    block = up_to(heads)
    inside = up_to(F.get(inner, block - 1))
    return F.when(value.isNull() | (block == 0), 0).otherwise((block - 1) * _STEP + inside)


def interleaved(buckets: Sequence[Column], bits: int) -> Column:
    """The bits of several numbers in turn, the highest first; the first number leads."""
    key = F.lit(0).cast("bigint")
    for bit in range(bits):
        for place, bucket in enumerate(reversed(buckets)):
            one = F.shiftright(bucket.cast("bigint"), bit).bitwiseAND(F.lit(1))
            key = key.bitwiseOR(F.shiftleft(one, bit * len(buckets) + place))
    return key


def z_key(cuts: Mapping[str, Sequence]) -> Column:
    """A row's key from the cuts of its columns, as many bits as the finest column needs."""
    bits = max(max((len(c).bit_length() for c in cuts.values()), default=1), 1)
    # Buckets are spread evenly over all the bits, so that every bit of a column halves its rows,
    # whatever its number of buckets.
    spread = [
        F.floor(F.shiftleft(bucket_of(F.col(name), c).cast("bigint"), bits) / (len(c) + 1))
        for name, c in cuts.items()
    ]
    return interleaved(spread, bits)


def clustered(
    rows: DataFrame, within: str, cuts: Mapping[str, Sequence], rest: Sequence[str]
) -> DataFrame:
    """The rows ranged by `within`, then by the key over the columns with cuts, then by `rest`.

    The key is only sorted by; the rows have the columns they had.
    """
    order = [within, "_z", *rest]
    keyed = rows.withColumn("_z", z_key(cuts))
    return keyed.repartitionByRange(*order).sortWithinPartitions(*order).drop("_z")
