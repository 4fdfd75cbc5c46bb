"""Byte-level BPE: encoding and decoding with a vocabulary given as ranks.

1. A task splits its documents by the pattern and numbers the distinct words it has not met yet.
2. Spark's higher-order functions encode those words: a fold over a word's pieces, at first its
   single bytes, merges the adjacent pair of the lowest rank until no pair is in the vocabulary. The
   ranks are a literal of the plan: an array of buckets, found by the pair's CRC, of pairs and ranks.
   The fold's state are the cuts between the pieces; a merge removes one. Each step looks up all pairs
   there are, which for short words costs less than to keep their ranks. A word of more than LONG_WORD
   bytes, for which that would take quadratic time, has been merged with a heap in step 1, by the same order.
3. Decoding maps ids to their binary pieces, a literal array, and concatenates them.
4. The same task puts the documents together from the ids and decoded bytes of its words.

Steps 1, 2 and 4 are one stage, partition by partition and in order: nothing is shuffled, a lost task
is simply run again, and memory is bounded by `MOST_WORDS` words and `BLOCK_BYTES` of text at a time.

Defined cases: a null or empty text has no tokens. Rows are encoded each for itself, so repeated rows
and ids, null ids too, give a row each. Strings that look like special tokens are ordinary text.
"""

from __future__ import annotations

import base64
import heapq
import json
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from blotter.llm.common import NULL_ID, given_id

# The literal's buckets: some times as many as there are tokens. Most are empty and null, which ends a search.
BUCKETS = 1 << 17
# Ranks are held beside a place in a word, so that the smallest is the leftmost of the lowest rank.
PLACE_BITS = 9
# A task forgets the words it has met when they are this many.
MOST_WORDS = 1_000_000
# Documents that travel together.
BLOCK_BYTES = 4 << 20

# A fold takes time with the square of a word's length; longer words than this are merged with a heap.
LONG_WORD = 256

_RANKS = "array<array<struct<k: binary, v: bigint>>>"
_WORDS = (
    "words array<binary>, ready array<array<int>>, forget boolean, docs array<struct<_id: bigint, idx: binary>>"
)


def read_ranks(path: str) -> dict[bytes, int]:
    """A rank file: one base64 token and its rank a line. As large as a vocabulary, not as the data."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value), with the value computed once."""
    # get() would derive the type of the whole expression again for every value.
    return F.element_at(F.transform(F.array(value), use), F.lit(1))


def rank_literal(ranks: dict[bytes, int]) -> Column:
    buckets: list[list[dict] | None] = [None] * BUCKETS
    for token, rank in ranks.items():
        entry = {"k": base64.b64encode(token).decode(), "v": rank << PLACE_BITS}
        place = zlib.crc32(token) % BUCKETS
        buckets[place] = [*(buckets[place] or []), entry]
    return F.from_json(F.lit(json.dumps(buckets, separators=(",", ":"))), _RANKS)


def piece_literal(ranks: dict[bytes, int]) -> Column:
    """The tokens' bytes, at the place of their id."""
    tokens: list[str | None] = [None] * (max(ranks.values(), default=-1) + 1)
    for token, rank in ranks.items():
        tokens[rank] = base64.b64encode(token).decode()
    return F.from_json(F.lit(json.dumps(tokens, separators=(",", ":"))), "array<binary>")


def _rank(table: Column, piece: Column) -> Column:
    """The piece's rank, shifted by PLACE_BITS; null if it is no token."""
    bucket = F.get(table, F.pmod(F.crc32(piece), F.lit(BUCKETS)))
    none = F.lit(None).cast("bigint")
    return F.aggregate(bucket, none, lambda found, e: F.when(e["k"] == piece, e["v"]).otherwise(found))


def encode_word(table: Column, word: Column) -> Column:
    """The ids of a word (binary, not empty, of fewer than 1 << PLACE_BITS bytes)."""
    size = F.octet_length(word)

    def piece(begin: Column, end: Column) -> Column:
        return _rank(table, F.substring(word, begin, end - begin))

    def merge(cuts: Column) -> Column:
        """Without the cut between the leftmost pair of the lowest rank, if any pair has one."""
        pairs = F.transform(
            cuts, lambda at, k: piece(at, F.get(cuts, k + 2)) + F.get(cuts, k + 1).cast("bigint")
        )
        place = F.pmod(F.array_min(pairs), F.lit(1 << PLACE_BITS)).cast("int")
        return F.coalesce(F.array_remove(cuts, place), cuts)

    def ids(cuts: Column) -> Column:
        ranks = F.transform(cuts, lambda at, k: piece(at, F.get(cuts, k + 1)))
        return F.transform(F.filter(ranks, lambda r: r.isNotNull()), _id)

    # A word that is a token as a whole needs no merging; others end as two pieces or more.
    merged = F.aggregate(
        F.sequence(F.lit(3), size), F.sequence(F.lit(1), size + 1), lambda cuts, _: merge(cuts)
    )
    whole = lambda r: F.when(r.isNotNull(), F.array(_id(r))).otherwise(_let(merged, ids))
    return _let(_rank(table, word), whole)


def _id(rank: Column) -> Column:
    return F.shiftright(rank, PLACE_BITS).cast("int")


def decode(ids: Column, pieces: Column) -> Column:
    """The bytes of an array of ids: their binary pieces, one after the other."""
    return F.aggregate(ids, F.lit(b""), lambda before, i: F.concat(before, F.get(pieces, i)))


def encode_long(ranks: dict[bytes, int], word: bytes) -> list[int]:
    """The ids of a word, in time that hardly grows faster than the word.

    The fold's merges in the fold's order: the lowest rank first, from left to right, by a heap of the
    pairs there are.
    """
    if word in ranks:
        return [ranks[word]]
    pieces: list[bytes | None] = [word[at : at + 1] for at in range(len(word))]
    after = [*range(1, len(word)), None]
    before = [None, *range(len(word) - 1)]
    heap = [
        (ranks[pair], place)
        for place in range(len(word) - 1)
        if (pair := word[place : place + 2]) in ranks
    ]
    heapq.heapify(heap)
    while heap:
        rank, place = heapq.heappop(heap)
        other = after[place]
        if other is None or pieces[place] is None:
            continue
        piece = pieces[place] + pieces[other]
        if ranks.get(piece) != rank:
            continue
        pieces[place], pieces[other] = piece, None
        beyond = after[place] = after[other]
        after[other] = None
        if beyond is not None:
            before[beyond] = place
            if (pair := piece + pieces[beyond]) in ranks:
                heapq.heappush(heap, (ranks[pair], place))
        if (left := before[place]) is not None and (pair := pieces[left] + piece) in ranks:
            heapq.heappush(heap, (ranks[pair], left))
    return [ranks[piece] for piece in pieces if piece is not None]


class _Words(dict):
    """Numbers words as they come; `fresh` are those not encoded yet."""

    def __init__(self) -> None:
        super().__init__()
        self.fresh: list[str] = []

    def __missing__(self, word: str) -> int:
        self.fresh.append(word)
        number = self[word] = len(self)
        return number


def _split(pattern: str, shared: Broadcast):
    """Documents to blocks: new words, and every document as word numbers. Long words come encoded."""

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = regex.compile(pattern).findall
        known = _Words()
        forget, docs, size = True, [], 0

        def flush() -> pa.RecordBatch:
            nonlocal docs, size, forget, known
            words = [w.encode() for w in known.fresh]
            ready = [encode_long(shared.value, w) if len(w) > LONG_WORD else None for w in words]
            words = [w if r is None else b"" for w, r in zip(words, ready)]
            row = {"words": words, "ready": ready, "forget": forget, "docs": docs}
            known.fresh = []
            docs, size, forget = [], 0, len(known) >= MOST_WORDS
            if forget:
                known = _Words()
            schema = pa.schema(
                [
                    ("words", pa.list_(pa.binary())),
                    ("ready", pa.list_(pa.list_(pa.int32()))),
                    ("forget", pa.bool_()),
                    ("docs", pa.list_(pa.struct([("_id", pa.int64()), ("idx", pa.binary())]))),
                ]
            )
            return pa.RecordBatch.from_pylist([row], schema=schema)

        for batch in batches:
            for doc_id, text in zip(batch.column("_id").to_pylist(), batch.column("_text")):
                whole = text.as_py()
                numbers = np.fromiter(map(known.__getitem__, find(whole)), dtype="<u4")
                docs.append({"_id": doc_id, "idx": numbers.tobytes()})
                size += len(whole)
                if size >= BLOCK_BYTES:
                    yield flush()
        if docs:
            yield flush()

    return split


def _join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents from the ids and bytes of their words."""
    codes: list[bytes] = []
    plain: list[bytes] = []
    for batch in batches:
        for row in range(batch.num_rows):
            if batch.column("forget")[row].as_py():
                codes, plain = [], []
            lists = batch.column("ids")[row].values
            ids = lists.flatten().to_numpy(zero_copy_only=False).astype("<u4").tobytes()
            ends = np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False)) * 4
            codes.extend(ids[a:b] for a, b in zip([0, *ends], ends))
            plain.extend(batch.column("plain")[row].as_py())
            docs = batch.column("docs")[row].as_py()
            numbers = [np.frombuffer(doc["idx"], dtype="<u4").tolist() for doc in docs]
            yield pa.record_batch(
                {
                    "_id": pa.array([doc["_id"] for doc in docs], pa.int64()),
                    "ids": pa.array([b"".join([codes[i] for i in n]) for n in numbers], pa.binary()),
                    "decoded": pa.array([b"".join([plain[i] for i in n]) for n in numbers], pa.binary()),
                }
            )


def encode(docs: DataFrame, ranks: dict[bytes, int], pattern: str) -> DataFrame:
    """Per row: doc_id, n_tokens, ids (little-endian unsigned 32 bit) and decoded, the ids' bytes."""
    texts = docs.select(
        F.coalesce(F.col("doc_id").cast("bigint"), F.lit(NULL_ID)).alias("_id"),
        F.coalesce(F.col("text"), F.lit("")).alias("_text"),
    )
    shared = docs.sparkSession.sparkContext.broadcast(ranks)  # as large as a vocabulary
    blocks = texts.mapInArrow(_split(pattern, shared), _WORDS)

    def ids(table: Column) -> Column:
        folded = lambda word, ready: F.when(ready.isNotNull(), ready).otherwise(encode_word(table, word))
        return F.zip_with("words", "ready", folded)

    coded = _let(rank_literal(ranks), ids)
    encoded = blocks.select("forget", "docs", coded.alias("ids"))
    plain = _let(piece_literal(ranks), lambda t: F.transform("ids", lambda ids: decode(ids, t)))
    whole = encoded.select("forget", "docs", "ids", plain.alias("plain")).mapInArrow(
        _join, "_id long, ids binary, decoded binary"
    )
    n_tokens = (F.octet_length("ids") / 4).cast("bigint")
    return whole.select(given_id(), n_tokens.alias("n_tokens"), "ids", "decoded")


def encoding_report(encoded: DataFrame) -> DataFrame:
    return encoded.select(
        "doc_id",
        "n_tokens",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
