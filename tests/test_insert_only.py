"""Deduplication and insert-only merging."""

from __future__ import annotations

import hashlib
import re

from pyspark.sql import functions as F

from blotter.operators import insert_only
from blotter.operators.insert_only import first_copies, new_rows
from blotter.sources.tables import read_table
from tests.plans import executed_plan

SCHEMA = "trade_id string, at int, note string"


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_earliest_then_smallest_copy_wins(spark):
    batch = spark.createDataFrame(
        [("a", 2, "late"), ("a", 1, "z"), ("a", 1, "b"), ("a", None, "a"), ("b", None, "x"), ("c", 3, "c")],
        SCHEMA,
    )
    assert rows(first_copies(batch, "trade_id", F.col("at"))) == [
        ("a", 1, "b"), ("b", None, "x"), ("c", 3, "c"),
    ]


def test_only_unknown_keys_are_new(spark):
    batch = spark.createDataFrame([("a", 1, "n"), ("b", 1, "n"), ("b", 2, "n")], SCHEMA)
    target = spark.createDataFrame([("a", 9, "old"), ("z", 9, "old")], SCHEMA)
    assert rows(new_rows(batch, target, "trade_id", F.col("at"))) == [("b", 1, "n")]
    assert rows(new_rows(batch, None, "trade_id", F.col("at"))) == [("a", 1, "n"), ("b", 1, "n")]


def test_copies_are_dropped_before_the_shuffle(spark):
    """A key with very many copies must not be gathered in one task."""
    copies = spark.range(100_000, numPartitions=8).select(
        F.concat(F.lit("same"), F.col("id").cast("string").substr(9, 9)).alias("trade_id"),
        F.col("id").alias("at"),
        F.lit("x").alias("note"),
    )
    unique = first_copies(copies, "trade_id", F.col("at"))
    plan = executed_plan(unique)
    limits = [i for i, row in enumerate(plan.splitlines()) if "WindowGroupLimit" in row]
    (shuffle,) = [i for i, row in enumerate(plan.splitlines()) if "Exchange" in row]
    assert limits[0] < shuffle < limits[1], "one limit per key below the shuffle, one above"
    assert rows(unique) == [("same", 0, "x")]


def test_only_the_partitions_of_arriving_ids_are_read(spark, cfg, tmp_path):
    """The same Bronze as without partitions, and a load of one prefix reads one of 16."""
    from dataclasses import replace

    from blotter.plans import jobs
    from tests.conftest import line
    from tests.plans import executed_plan

    one_prefix = [i for i in (f"t{n}" for n in range(400)) if hashlib.md5(i.encode()).hexdigest()[0] == "a"]
    loads = [[f"t{n}" for n in range(200)], [f"t{n}" for n in range(150, 260)], one_prefix]
    found = {}
    for digits in (0, 1):
        own = replace(cfg, root=f"{cfg.root}/{digits}", bronze_digits=digits)
        counts = []
        for number, ids in enumerate(loads):
            path = tmp_path / f"{digits}-{number}.jsonl"
            path.write_text("\n".join(line(trade_id=i) for i in ids) + "\n")
            counts.append(jobs.ingest(spark, str(path), own)["inserted_count"])
        found[digits] = counts, sorted(r.trade_id for r in jobs.bronze(spark, own).collect())
        assert jobs.transform(spark, own)["silver"] == len(found[digits][1])
    assert found[0] == found[1] and found[0][0][0] == 200

    batch = spark.createDataFrame([(i,) for i in one_prefix], "trade_id string")
    table = read_table(spark, own.bronze_path, own, jobs._bronze_schema(own))
    pruned = insert_only.reachable(table, batch, "trade_id", 1)
    read = {r.f.split("_prefix=")[1][0] for r in pruned.selectExpr("_metadata.file_path AS f").distinct().collect()}
    assert read == {"a"} and table.select("_prefix").distinct().count() == 16
    assert re.search(r"PartitionFilters: \[.*_prefix.*a", executed_plan(pruned))
