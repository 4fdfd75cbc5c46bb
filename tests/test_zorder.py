"""The clustering key and the tables clustered by it."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from blotter.operators import zorder


def key_of(buckets: list[int], bits: int) -> int:
    out = 0
    for bit in reversed(range(bits)):
        for bucket in buckets:
            out = out << 1 | bucket >> bit & 1
    return out


def test_bits_are_interleaved(spark):
    rng = random.Random(2)
    rows = [(rng.randrange(256), rng.randrange(256), rng.randrange(256)) for _ in range(200)]
    df = spark.createDataFrame(rows, "a int, b int, c int")
    for r in df.select("*", zorder.interleaved([F.col(c) for c in "abc"], 8).alias("z")).collect():
        assert r.z == key_of([r.a, r.b, r.c], 8)


@pytest.mark.parametrize("distinct", [1, 15, 255, 256, 3000])
def test_buckets_are_quantiles(spark, distinct):
    rng = random.Random(3)
    values = [rng.randrange(distinct) for _ in range(9000)] + [distinct // 2] * 4000
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], "v int")
    cuts = zorder.quantile_cuts(df, "v")
    assert len(cuts) <= 254 and cuts == sorted(set(cuts))
    found = df.select("v", zorder.bucket_of(F.col("v"), cuts).alias("b")).collect()
    for r in found:
        assert r.b == (0 if r.v is None else sum(cut <= r.v for cut in cuts))
    sizes = {}
    for r in found:
        if r.v != distinct // 2:
            sizes[r.b] = sizes.get(r.b, 0) + 1
    if distinct > 255:
        assert len(cuts) > 120 and max(sizes.values()) <= 4 * 13000 / 255


def test_no_values_no_cuts(spark):
    df = spark.createDataFrame([(None,)], "v string")
    assert zorder.quantile_cuts(df, "v") == []
    assert df.select(zorder.z_key({"v": []}).alias("z")).first().z == 0


def groups_read(spark, path: str, condition: str) -> tuple[int, int]:
    """Row groups whose statistics let a filter in, and all row groups."""
    import pyarrow.parquet as pq
    from pathlib import Path

    name, value = condition.split("=")
    read = every = 0
    for file in Path(path).rglob("*.parquet"):
        meta = pq.ParquetFile(file).metadata
        at = meta.schema.names.index(name)
        for group in range(meta.num_row_groups):
            stats = meta.row_group(group).column(at).statistics
            every += 1
            read += stats.min <= value <= stats.max
    return read, every


def test_filters_on_either_column_skip(spark, tmp_path):
    rows = spark.range(400_000).selectExpr(
        "DATE'2026-01-05' AS trade_date", "concat('TDR_', lpad(pmod(hash(id), 64), 3, '0')) AS trader_id",
        "concat('I', lpad(pmod(hash(id, 7), 16), 2, '0')) AS instrument", "id AS trade_id",
    )
    cuts = {name: zorder.quantile_cuts(rows, name) for name in ("trader_id", "instrument")}
    layouts = {
        "z": zorder.clustered(rows.repartition(4), "trade_date", cuts, ["trade_id"]),
        "sorted": rows.repartitionByRange("trader_id", "instrument").sortWithinPartitions("trader_id", "instrument"),
    }
    read = {}
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        for name, df in layouts.items():
            df.write.parquet(str(tmp_path / name))
            for condition in ("instrument=I05", "trader_id=TDR_020"):
                read[name, condition.split("=")[0]], every = groups_read(spark, str(tmp_path / name), condition)
                assert every >= 60
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert read["z", "instrument"] <= 0.3 * read["sorted", "instrument"]
    assert read["z", "trader_id"] <= 12
