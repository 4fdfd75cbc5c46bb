"""Best-fit packing of tokenized documents into sequences of a fixed length.

1. Tasks tokenize whole documents and cut only those longer than a sequence; the short piece comes
   first, the others are full. Pieces are written once to shared storage, with their token ids.
2. Bulk-synchronous best fit. Documents and gaps are kept in order of size as runs: a run of
   documents is a length and a range of ranks, a run of gaps a size and a range of sequences. A
   superstep takes the longest pieces that are left and sweeps over the gaps from their length
   upwards: the smallest gap that fits (the successor) takes them. Pieces that want the same gap
   are told apart by rank, the gaps are updated, and the next shorter length follows. Runs are at
   most as many as there are lengths and gaps, never as many as documents, so a superstep costs
   the same at any size and moves no document. The outcome is that of best-fit decreasing.
3. The ranks of pieces within a length are counted in buckets by hash, so that no length, however
   common, is ranked by one task; a piece then looks its place up by length and rank.

Defined cases: a null or empty text is the end token alone. Repeated rows and rows with equal or
null ids are packed each for itself. Strings of the special tokens that are given are these tokens.
"""

from __future__ import annotations

import base64
import functools
import json
from collections import defaultdict
from collections.abc import Iterator, Mapping
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from blotter.llm.common import given_id, keyed, partitions, stored

CAPACITY = 1024
END = 2

_PIECES = "pid long, _id long, piece int, start long, length long, ids binary"


@functools.lru_cache(maxsize=4)
def encoding(ranks_path: str, pattern: str, special: tuple[tuple[str, int], ...] = ()) -> tiktoken.Encoding:
    """The tokenizer of a rank file and special tokens, made once per worker."""
    with open(ranks_path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens=dict(special))


def cut_points(n: int, capacity: int) -> list[int]:
    """Where the pieces of n tokens begin, and n: a short first piece, then full ones."""
    short = n % capacity or capacity
    return [0, *range(short, n + 1, capacity)]


def special_tokens(tokenizer_path: str) -> tuple[tuple[str, int], ...]:
    """The special tokens of a tokenizer file, whose strings it takes for them."""
    with open(tokenizer_path, encoding="utf-8") as file:
        return tuple((token["content"], token["id"]) for token in json.load(file)["added_tokens"])


def tokenize(
    docs: DataFrame,
    ranks_path: str,
    pattern: str,
    capacity: int = CAPACITY,
    end: int = END,
    special: tuple[tuple[str, int], ...] = (),
) -> DataFrame:
    """Pieces: pid (unique), _id, piece, start, length and ids (little-endian unsigned 32 bit)."""

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoding(ranks_path, pattern, special)
        next_pid = TaskContext.get().partitionId() << 40
        for batch in batches:
            owner, piece, start, length, ids = [], [], [], [], []
            for row, text in enumerate(batch.column("_text")):
                tokens = np.append(
                    encoder.encode_to_numpy(text.as_py(), allowed_special="all").astype("<u4"),
                    np.array([end], dtype="<u4"),
                )
                cuts = cut_points(len(tokens), capacity)
                for number, (a, b) in enumerate(zip(cuts, cuts[1:])):
                    owner.append(row)
                    piece.append(number)
                    start.append(a)
                    length.append(b - a)
                    ids.append(tokens[a:b].tobytes())
            pids = np.arange(next_pid, next_pid + len(owner))
            next_pid += len(owner)
            yield pa.record_batch(
                {
                    "pid": pids,
                    "_id": batch.column("_id").take(pa.array(owner, pa.int64())),
                    "piece": pa.array(piece, pa.int32()),
                    "start": pa.array(start, pa.int64()),
                    "length": pa.array(length, pa.int64()),
                    "ids": pa.array(ids, pa.binary()),
                }
            )

    return keyed(docs).select("_id", "_text").mapInArrow(pieces, _PIECES)


@dataclass(frozen=True)
class Plan:
    """Runs of pieces: those of `length` from rank `rank` on go to sequences from `first` on."""

    key: np.ndarray  # length << 40 | rank, ascending
    first: np.ndarray
    offset: np.ndarray


def best_fit(counts: Mapping[int, int], capacity: int) -> Plan:
    """The supersteps over all lengths, longest first, from the number of pieces of each length."""
    gaps: dict[int, list[tuple[int, int]]] = defaultdict(list)  # gap: runs (first sequence, how many)
    opened = 0
    rows: list[tuple[int, int, int]] = []
    for length in sorted(counts, reverse=True):
        left, rank = counts[length], 0
        while left:
            gap = next((g for g in range(length, capacity + 1) if gaps[g]), None)
            each = (gap or capacity) // length
            if gap is None:  # nothing fits: open sequences for all that is left
                gap, new = capacity, -(-left // each)
                gaps[gap].append((opened, new))
                opened += new
            first, size = gaps[gap].pop()
            filled = min(size, left // each)
            if filled == 0:  # fewer pieces than one sequence takes
                filled, each = 1, left
            for nth in range(each):
                rows.append((length << 40 | rank, first, capacity - gap + nth * length))
                rank += filled
            left -= filled * each
            if filled < size:
                gaps[gap].append((first + filled, size - filled))
            if gap > each * length:
                gaps[gap - each * length].append((first, filled))
    columns = np.array(sorted(rows), dtype=np.int64).reshape(-1, 3)
    return Plan(*(np.ascontiguousarray(columns[:, i]) for i in range(3)))


def places(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """pid, sequence_id and offset of every piece."""
    buckets = partitions(pieces.sparkSession)
    thin = pieces.select("pid", "length", F.pmod(F.xxhash64("pid"), F.lit(buckets)).alias("bucket"))
    per_bucket = thin.groupBy("length", "bucket").agg(F.count(F.lit(1)).alias("n"))
    earlier = (
        Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    )
    offsets = per_bucket.select(
        "length", "bucket", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before")
    )
    inside = Window.partitionBy("length", "bucket").orderBy("pid")
    ranked = (
        thin.withColumn("nth", F.row_number().over(inside))
        .join(offsets, ["length", "bucket"])
        .select("pid", "length", (F.col("before") + F.col("nth") - 1).alias("rank"))
    )
    # One count per length: as many as a sequence has tokens, at most.
    counts = {r.length: r.n for r in thin.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    plan = best_fit(counts, capacity)

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = batch.column("length").to_numpy(), batch.column("rank").to_numpy()
            wanted = (length << 40) | rank
            run = np.searchsorted(plan.key, wanted, side="right") - 1
            yield pa.record_batch(
                {
                    "pid": batch.column("pid"),
                    "sequence_id": plan.first[run] + wanted - plan.key[run],
                    "offset": plan.offset[run],
                }
            )

    return ranked.mapInArrow(look_up, "pid long, sequence_id long, offset long")


@dataclass(frozen=True)
class Packed:
    pieces: DataFrame
    places: DataFrame

    def sequences(self) -> DataFrame:
        """sequence_id, length, ids (little-endian unsigned 32 bit) and the documents in order."""
        placed = self.pieces.join(self.places, "pid")
        inside = F.array_sort(F.collect_list(F.struct("offset", given_id(), "length", "ids")))
        return placed.groupBy("sequence_id").agg(inside.alias("p")).select(
            "sequence_id",
            F.aggregate("p.length", F.lit(0).cast("bigint"), lambda a, x: a + x).alias("length"),
            F.aggregate("p.ids", F.lit(b""), lambda a, x: F.concat(a, x)).alias("ids"),
            F.col("p.doc_id").alias("doc_ids"),
            F.col("p.offset").alias("offsets"),
        )


def pack(
    docs: DataFrame,
    ranks_path: str,
    pattern: str,
    capacity: int = CAPACITY,
    end: int = END,
    special: tuple[tuple[str, int], ...] = (),
) -> Packed:
    pieces = stored(tokenize(docs, ranks_path, pattern, capacity, end, special))
    return Packed(pieces, places(pieces, capacity))


def packing_report(packed: Packed) -> DataFrame:
    """Per piece where it lies, with a checksum of its token ids."""
    summed = packed.pieces.select(
        "pid", given_id(), "piece", "start", "length", F.crc32("ids").alias("ids_crc32")
    )
    return summed.join(packed.places, "pid").drop("pid")
