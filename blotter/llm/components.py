"""Connected components of an edge list, by alternating large-star and small-star steps.

Every step is an aggregation, combined in the map tasks, and a join that Spark splits where a
node has very many edges. Each round is written to the shared folder, so its lineage stays short.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from blotter.llm.common import checkpointed


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is joined to the smallest node around it."""
    both = checkpointed(edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))))
    least = checkpointed(both.groupBy("u").agg(F.min("v").alias("m")))
    around = both.where(F.col("v") > F.col("u")).join(least, "u")
    return around.select(F.col("v").alias("u"), F.least("u", "m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Every node and its smaller neighbours are joined to the smallest of them; u > v throughout."""
    edges = checkpointed(edges)
    least = checkpointed(edges.groupBy("u").agg(F.min("v").alias("m")))
    others = edges.join(least, "u").where(F.col("v") > F.col("m"))
    return least.select("u", F.col("m").alias("v")).union(
        others.select(F.col("v").alias("u"), F.col("m").alias("v"))
    ).distinct()


def _state(edges: DataFrame) -> tuple:
    """Equal before and after a round only if the round changed nothing."""
    mark = F.xxhash64("u", "v").cast("decimal(20,0)")
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(mark)).first())


def components(edges: DataFrame) -> DataFrame:
    """u and the smallest node v it is connected with, for every node that isn't that one.

    `edges` has long columns u and v, in any direction and repeated or not.
    """
    larger, smaller = F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")
    current = checkpointed(edges.where(F.col("u") != F.col("v")).select(larger, smaller).distinct())
    before = _state(current)
    while before[0]:
        current = checkpointed(_small_star(_large_star(current)))
        after = _state(current)
        if after == before:
            break
        before = after
    return current
