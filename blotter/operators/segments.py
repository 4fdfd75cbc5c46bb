"""Cutting hot groups into ordered segments.

An ordered calculation over a group normally puts the whole group in one task. Here a group
that holds very many rows is cut along its order into segments small enough for a task each.
A segment is a pure function of the row and of the cut points, and those are a deterministic
sample of the data, so a recomputed task always assigns the same segments.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from blotter.config import Config

SEGMENT = "_segment"


def cut_points(
    rows: DataFrame, keys: Sequence[str], order: Sequence[str], cfg: Config
) -> DataFrame:
    """Cut points per group, numbered 1, 2, ... along the order.

    Rows are sampled by hash, one in `segment_rows / samples_per_cut` at any size, so a segment
    never outgrows a task. A group far below `segment_rows` gets no cut.
    """
    one_in = max(1, cfg.segment_rows // cfg.samples_per_cut)
    # Equal rows are sampled together; distinct() leaves one of them.
    sample = (
        rows.where(F.pmod(F.xxhash64(*order), F.lit(one_in)) == 0).select(*keys, *order).distinct()
    )
    along = Window.partitionBy(*keys).orderBy(*order)
    numbered = sample.withColumn("_n", F.row_number().over(along))
    return numbered.where(F.col("_n") % cfg.samples_per_cut == 0).select(
        *keys,
        F.struct(*order).alias("_from"),
        F.expr(f"CAST(_n DIV {cfg.samples_per_cut} AS INT)").alias(SEGMENT),
    )


def _cuts_by_group(cuts: DataFrame, keys: Sequence[str], cfg: Config) -> DataFrame:
    """One row per group with cuts: its blocks in order, each with its cuts in order."""
    block = F.expr(f"({SEGMENT} - 1) DIV {cfg.cuts_per_block}")
    blocks = cuts.groupBy(*keys, block.alias("_block")).agg(
        F.min("_from").alias("head"), F.array_sort(F.collect_list("_from")).alias("cuts")
    )
    inside = F.array_sort(F.collect_list(F.struct("head", "cuts")))
    return blocks.groupBy(*keys).agg(inside.alias("_blocks"))


def assign_segments(
    rows: DataFrame, keys: Sequence[str], order: Sequence[str], cfg: Config
) -> DataFrame:
    """Add `_segment`: 0 in a group without cuts, else the number of cuts at or before the row.

    The groups with cuts, which are few, join by their keys. Nothing is hinted: Spark broadcasts
    them while they are small, and otherwise shuffles and splits the hot groups.
    """
    groups = _cuts_by_group(cut_points(rows, keys, order, cfg), keys, cfg)
    place = F.struct(*order)

    def up_to(items: Column, start) -> Column:
        return F.size(F.filter(items, lambda item: start(item) <= place))

    n_blocks = up_to(F.col("_blocks"), lambda block: block["head"])
    in_block = up_to(F.get("_blocks", n_blocks - 1)["cuts"], lambda cut: cut)
    segment = (
        F.when(F.col("_blocks").isNull() | (n_blocks == 0), F.lit(0))
        .otherwise((n_blocks - 1) * cfg.cuts_per_block + in_block)
    )
    joined = rows.join(groups, list(keys), "left")
    return joined.select(*[F.col(name) for name in rows.columns], segment.alias(SEGMENT))
