"""Exact top-k by inner product, block at a time.

Vectors are integers; a component is a term, positive or negative. Vectors are range-sorted by id and
cut into blocks of `BLOCK`; a block keeps its forward index (its vectors) and the largest and
smallest weight of every term. For a query these give a bound no score in the block can exceed:
the sum over terms of the best the block has. A query takes the blocks in order of their bounds,
scores whole blocks through the forward index, and stops when the next bound is below its k-th
score. What is skipped can't matter, so the result is exact. Queries that come to the same block in
the same step (of 1, 1, 2, 4, 8 ... blocks) are scored by one matrix product.

Blocks travel in superblocks of up to `SUPER` vectors and queries in chunks of up to `CHUNK`, of at most
`COMPONENTS` numbers each. Every chunk meets every superblock in a Cartesian product of the two stored tables,
partition by partition: nothing is broadcast, copied per partition or collected. A task holds at most `HELD`
chunks, with their k-th scores, and streams through its superblocks; there are about as many tasks as shuffle
partitions, so that what they find grows with the input and not with its square. The best k of every task are
merged per query. Both tables are stored as large as they are in memory, so that the size of a
partition of files bounds what a task reads at once, also where vectors repeat.

Defined cases: vectors that are null or hold null, NaN or infinite components take no part, nor do rows
without an id. A missing component of a shorter vector counts as 0. A row is no candidate for
queries of its own id. Equal scores go to the smaller id. Repeated rows are candidates each; a query
id that repeats is asked once, with its smallest vector. Fewer candidates than k: all are returned.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from blotter.llm.common import partitions, stored

BLOCK = 128
SUPER = 2048
CHUNK = 4096
HELD = 8
COMPONENTS = 1 << 18
# Integers below the limit are exact in the type; the first that holds all sums is taken.
EXACT = ((np.float32, float(1 << 24)), (np.float64, float(1 << 52)))
LEAST = np.iinfo(np.int64).min
# Plain pages and small row groups, also of rows of half a megabyte.
PLAIN = {
    "compression": "uncompressed",
    "parquet.enable.dictionary": "false",
    "parquet.block.size": str(8 << 20),
    "parquet.page.size.row.check.min": "1",
}


def integer_vector(vector: Column, scale: int = 256) -> Column:
    """floor(scale * x) of every component, null for a vector that can't take part."""
    finite = F.forall(
        vector,
        lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < F.lit(float("inf"))),
    )
    scaled = F.transform(vector, lambda x: F.floor(x.cast("double") * F.lit(float(scale))))
    return F.when(vector.isNotNull() & finite, scaled)


def _matrix(rows: list[np.ndarray]) -> np.ndarray:
    """Rows of any length as one matrix, filled up with zeros."""
    width = max((len(row) for row in rows), default=0)
    out = np.zeros((len(rows), width), dtype=np.int64)
    for at, row in enumerate(rows):
        out[at, : len(row)] = row
    return out


def _packed(size: int):
    """Rows (vec_id, v) to rows of up to `size` vectors and `COMPONENTS` numbers: ids and components as binary."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids: list[int] = []
        rows: list[np.ndarray] = []
        width = 0

        def flush() -> pa.RecordBatch:
            matrix = _matrix(rows)
            narrow = matrix.astype("<i4")
            wide = bool((narrow != matrix).any())
            data = (matrix.astype("<i8") if wide else narrow).tobytes()
            return pa.record_batch(
                {
                    "ids": pa.array([np.array(ids, dtype="<i8").tobytes()], pa.binary()),
                    "data": pa.array([data], pa.binary()),
                    "wide": pa.array([wide]),
                }
            )

        for batch in batches:
            vectors = batch.column("v")
            values = vectors.flatten().to_numpy(zero_copy_only=False)
            ends = np.cumsum(vectors.value_lengths().to_numpy(zero_copy_only=False))
            for vec_id, end, start in zip(batch.column("vec_id").to_pylist(), ends, [0, *ends]):
                width = max(width, end - start)
                if ids and (len(ids) == size or (len(ids) + 1) * width > COMPONENTS):
                    yield flush()
                    ids, rows, width = [], [], end - start
                ids.append(vec_id)
                rows.append(values[start:end])
        if ids:
            yield flush()

    return pack


def _unpack(ids: bytes, data: bytes, wide: bool) -> tuple[np.ndarray, np.ndarray]:
    names = np.frombuffer(ids, dtype="<i8")
    values = np.frombuffer(data, dtype="<i8" if wide else "<i4").astype(np.int64)
    return names, values.reshape(len(names), -1)


def _of_width(matrix: np.ndarray, width: int) -> np.ndarray:
    return matrix if matrix.shape[1] == width else np.pad(matrix, ((0, 0), (0, width - matrix.shape[1])))


class Asked:
    """Queries and the k best of each among the vectors met so far, as flat arrays."""

    def __init__(self, ids: np.ndarray, queries: np.ndarray, k: int):
        self.ids, self.queries, self.k = ids, queries, k
        self.reach = np.abs(queries.astype(float)).sum(axis=1).max(initial=0)
        self.forms: dict[tuple[type, int], np.ndarray] = {}
        self.rows, self.best, self.scores = (np.empty(0, np.int64) for _ in range(3))
        self.kth = np.full(len(ids), LEAST)  # no score is below it while a query has fewer than k

    def form(self, kind: type, width: int) -> np.ndarray:
        if (kind, width) not in self.forms:
            self.forms = {(kind, width): _of_width(self.queries, width).astype(kind)}
        return self.forms[kind, width]

    def add(self, rows: np.ndarray, ids: np.ndarray, scores: np.ndarray) -> None:
        changed = np.zeros(len(self.ids), bool)
        changed[rows] = True
        again = changed[self.rows]
        same = ~again
        rows = np.concatenate([self.rows[again], rows])
        ids = np.concatenate([self.best[again], ids])
        scores = np.concatenate([self.scores[again], scores])
        order = np.lexsort((ids, ~scores, rows))  # ~ turns the order of all integers around
        rows = rows[order]
        place = np.arange(len(rows)) - np.searchsorted(rows, rows)
        order, rows, place = (x[place < self.k] for x in (order, rows, place))
        last = place == self.k - 1
        self.kth[rows[last]] = scores[order][last]
        self.rows = np.concatenate([self.rows[same], rows])
        self.best = np.concatenate([self.best[same], ids[order]])
        self.scores = np.concatenate([self.scores[same], scores[order]])

    def meet(self, ids: np.ndarray, vectors: np.ndarray, block: int = BLOCK) -> None:
        """Improve the best by these vectors."""
        width = max(self.queries.shape[1], vectors.shape[1])
        # No sum of products, of any part of the terms, is larger.
        limit = self.reach * np.abs(vectors.astype(float)).max(initial=0)
        kind = next((kind for kind, below in EXACT if limit < below), np.int64)
        queries, vectors = self.form(kind, width), _of_width(vectors, width).astype(kind)
        cuts = range(0, len(ids), block)
        largest = np.array([vectors[c : c + block].max(axis=0) for c in cuts])
        smallest = np.array([vectors[c : c + block].min(axis=0) for c in cuts])
        bounds = np.maximum(queries, 0) @ largest.T + np.minimum(queries, 0) @ smallest.T
        place = np.empty(bounds.shape, np.int32)
        order = np.argsort(-bounds, axis=1, kind="stable")
        np.put_along_axis(place, order, np.arange(len(cuts), dtype=np.int32)[None, :], axis=1)
        start, end = 0, 1
        while start < len(cuts):
            kth = self.kth.astype(kind)
            wanted = (place >= start) & (place < end) & (bounds >= kth[:, None])
            start, end = end, 2 * end
            met = []
            for chosen in np.flatnonzero(wanted.any(axis=0)):
                asking = np.flatnonzero(wanted[:, chosen])
                part = slice(chosen * block, (chosen + 1) * block)
                scores = queries[asking] @ vectors[part].T
                least = kth[asking]
                if self.k < scores.shape[1] and (self.kth[asking] == LEAST).any():
                    own = ids[part] == self.ids[asking, None]
                    others = np.where(own, np.array(LEAST).astype(kind), scores)
                    least = np.maximum(least, np.partition(others, -self.k, axis=1)[:, -self.k])
                row, column = np.divmod(np.flatnonzero(scores >= least[:, None]), scores.shape[1])
                other = ids[part][column] != self.ids[asking[row]]
                row, column = row[other], column[other]
                if len(row):
                    met.append((asking[row], ids[part][column], scores[row, column].astype(np.int64)))
            if met:
                self.add(*(np.concatenate(parts) for parts in zip(*met)))


def search(
    query_ids: np.ndarray, queries: np.ndarray, ids: np.ndarray, vectors: np.ndarray, k: int, block: int = BLOCK
) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Per query: its id, and the ids and scores of its k best among the vectors."""
    asked = Asked(query_ids, queries, k)
    asked.meet(ids, vectors, block)
    order = np.lexsort((asked.best, ~asked.scores, asked.rows))
    cuts = np.searchsorted(asked.rows[order], np.arange(len(query_ids) + 1))
    for query_id, start, end in zip(query_ids, cuts, cuts[1:]):
        yield int(query_id), asked.best[order[start:end]], asked.scores[order[start:end]]


def top_k(vectors: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """query_id, rank, vec_id and score of the k best vectors of every query.

    Both sides have vec_id and v, an integer vector from `integer_vector`.
    """
    groups = partitions(vectors.sparkSession)
    packed = "ids binary, data binary, wide boolean"
    ordered = vectors.repartitionByRange(groups, "vec_id").sortWithinPartitions("vec_id")
    blocks = stored(ordered.mapInArrow(_packed(SUPER), packed), **PLAIN)
    asked = queries.groupBy("vec_id").agg(F.min("v").alias("v"))
    chunks = stored(asked.mapInArrow(_packed(CHUNK), packed), **PLAIN)
    held = -(-chunks.count() // HELD) or 1
    dealt = chunks.select(*[F.col(c).alias(f"q_{c}") for c in chunks.columns]).repartition(held)
    streams = blocks.coalesce(-(-groups // held))

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        met: dict[bytes, Asked] = {}
        for batch in batches:
            for row in range(batch.num_rows):
                ids, data, wide, q_ids, q_data, q_wide = (column[row] for column in batch.columns)
                names = q_ids.as_py()
                if names not in met:
                    met[names] = Asked(*_unpack(names, q_data.as_py(), q_wide.as_py()), k)
                met[names].meet(*_unpack(ids.as_py(), data.as_py(), wide.as_py()))
        for chunk in met.values():
            if len(chunk.rows):
                yield pa.record_batch(
                    {"query_id": chunk.ids[chunk.rows], "vec_id": chunk.best, "score": chunk.scores}
                )

    # Sizes of files say little of sizes in memory: with this hint no side is broadcast.
    pairs = streams.crossJoin(dealt.hint("shuffle_replicate_nl"))
    best = pairs.mapInArrow(meet, "query_id long, vec_id long, score long")
    by_score = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = best.withColumn("rank", F.row_number().over(by_score)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def top_k_of_embeddings(embeddings: DataFrame, every: int = 50, k: int = 5) -> DataFrame:
    """Every `every`-th id against all rows."""
    usable = embeddings.select(
        F.col("vec_id").cast("bigint").alias("vec_id"), integer_vector(F.col("embedding")).alias("v")
    ).where(F.col("vec_id").isNotNull() & F.col("v").isNotNull())
    return top_k(usable, usable.where(F.col("vec_id") % every == 0), k)
