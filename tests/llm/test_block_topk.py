from __future__ import annotations

import math
import random

import numpy as np
import pyarrow as pa
import pytest

from blotter.llm import block_topk
from tests.plans import executed_plan


def expected(rows, every, k):
    usable = [
        (i, [math.floor(256 * x) for x in v])
        for i, v in rows
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    asked = {}
    for i, v in usable:
        if i % every == 0:
            asked[i] = min(v, asked.get(i, v))
    out = []
    for q, v in asked.items():
        scored = sorted((-sum(a * b for a, b in zip(v, w)), i) for i, w in usable if i != q)
        out += [(q, rank, i, -s) for rank, (s, i) in enumerate(scored[:k], start=1)]
    return sorted(out)


def found(spark, rows, every, k):
    frame = spark.createDataFrame(
        [(i, v, -1, -1) for i, v in rows], "vec_id long, embedding array<float>, v long, score long"
    )
    return sorted(tuple(r) for r in block_topk.top_k_of_embeddings(frame, every, k).collect())


def as_floats(rows):
    return [(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v]) for i, v in rows]


@pytest.mark.parametrize("coarse", [False, True])
def test_equals_scoring_everything(spark, coarse):
    rng = random.Random(5)
    rows = [(i, [rng.gauss(0, 0.2) for _ in range(8)]) for i in range(700)]
    if coarse:  # many equal scores
        rows = [(i, [round(x * 4) / 4 for x in v]) for i, v in rows]
    rows = as_floats(rows)
    assert found(spark, rows, 50, 5) == expected(rows, 50, 5)


def test_odd_rows(spark):
    rows = as_floats([
        (0, [1.0, 2.0]), (0, [0.5, 9.0]), (1, None), (2, [None, 1.0]), (3, [math.nan, 1.0]),
        (4, [math.inf, 1.0]), (5, [1.0]), (6, []), (7, [1.0, 2.0, 3.0]), (None, [5.0, 5.0]),
        (50, [1.0, 2.0]), (50, [1.0, 2.0]), (8, [-1.0, -2.0]), (9, [1e7, -1e7]), (100, [3e6, 3e6]),
    ])
    assert found(spark, rows, 50, 5) == expected(rows, 50, 5)
    assert found(spark, rows[:1], 50, 5) == []
    assert found(spark, rows[2:3], 50, 5) == []


def test_blocks_are_skipped():
    """Clustered vectors: only the block of the query has a bound that reaches its k-th score."""
    ids = np.arange(4096)
    vectors = np.repeat(np.eye(32, dtype=np.int64) * 200, 128, axis=0)

    query = vectors[:1]
    (_, best, scores), = block_topk.search(np.array([-1]), query, ids, vectors, 5)
    assert best.tolist() == [0, 1, 2, 3, 4] and set(scores.tolist()) == {40000}
    blocks = vectors.reshape(32, 128, 32)
    bounds = np.maximum(query, 0) @ blocks.max(axis=1).T + np.minimum(query, 0) @ blocks.min(axis=1).T
    assert (bounds >= scores[-1]).sum() == 1


def test_nothing_is_broadcast(spark):
    """Small files may hold large tables: these vectors take a few hundred bytes, repeated per partition megabytes."""
    frame = spark.range(20_000).selectExpr("id AS vec_id", "array_repeat(float(1), 64) AS embedding")
    found = block_topk.top_k_of_embeddings(frame)
    assert "Broadcast" not in executed_plan(found) and "CartesianProduct" in executed_plan(found)
    rows = found.where("query_id < 100").collect()
    assert sorted((r.query_id, r.rank, r.vec_id) for r in rows) == [
        *[(0, rank, rank) for rank in range(1, 6)], *[(50, rank, rank - 1) for rank in range(1, 6)]
    ]
    assert {r.score for r in rows} == {64 * 256 * 256}


def test_chunks_meet_every_superblock(spark, monkeypatch):
    monkeypatch.setattr(block_topk, "SUPER", 40)
    monkeypatch.setattr(block_topk, "CHUNK", 3)
    rng = random.Random(6)
    rows = as_floats([(i % 900, [rng.gauss(0, 0.2) for _ in range(rng.randrange(1, 6))]) for i in range(1000)])
    assert found(spark, rows, 10, 7) == expected(rows, 10, 7)


def test_rows_of_wide_vectors_are_small():
    width = block_topk.COMPONENTS // 4
    batch = pa.record_batch({"vec_id": range(10), "v": pa.array([[1] * width] * 9 + [[2]])})
    packed = list(block_topk._packed(2048)(iter([batch])))
    unpacked = [block_topk._unpack(*(b.column(name)[0].as_py() for name in b.schema.names)) for b in packed]
    assert [ids.tolist() for ids, _ in unpacked] == [[0, 1, 2, 3], [4, 5, 6, 7], [8, 9]]
    assert all(values.size <= block_topk.COMPONENTS for _, values in unpacked)
    assert unpacked[-1][1].sum() == width + 2
