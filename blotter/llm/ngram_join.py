"""Documents whose sets of word shingles have a Jaccard similarity of at least 0.75, as classes.

Index. A set's tokens are ordered rarest first; two similar sets share one of the first
quarter of their tokens, so only those are indexed. Which tokens are frequent is estimated
from a sample of documents; any order gives right results, a good one gives short lists.

Skipping by position. Tokens that no other set has among its first are dropped from the index. If a
token is the first that two sets share, everything before it is in one of them only. A list
keeps an entry only if some other entry leaves enough room for that.

Set relations. Each list names one leader, the set with the fewest dropped tokens, so that
the lists of a family of near copies agree on one. The sets of all its lists meet there, first as
sketches of short hashes, which bound what two sets share: pairs below the bound are done with. What is
left falls into groups. A whole set is sent to its one group, where overlaps come from one product
of the members' incidence matrix. Sets that are equal were made one before, and a meeting
answers with one link per member, not per pair. A large meeting is split into pairs of chunks.

Classes are connected components of these links.

Defined cases: without words or text a set is empty and linked with nothing. With fewer than five
words, the sequence of all is the only shingle. Rows of one id are one document (a null id is an
id too), whichever their texts. A text of any length is one set.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from blotter.llm.common import (
    checkpointed,
    discard,
    given_id,
    keyed,
    release,
    small_enough,
    stored,
    with_key,
)
from blotter.llm.components import components
from blotter.llm.tokens import (
    batched,
    distinct,
    frequent_tokens,
    gram_hashes,
    hashed_documents,
    shared_only,
)

WORDS = 5
# Similar: 100 * intersection >= PERCENT * union.
PERCENT = 75

# Sets that are compared at once come in chunks of this many; two chunks meet in a task.
MEETING = 512
MEETING_TOKENS = 500_000
# The incidence matrix is multiplied in this many columns at a time.
COLUMNS = 8192

def shingles(words: np.ndarray, size: int = WORDS) -> np.ndarray:
    """The sorted 64-bit hashes of the distinct shingles, from the words' hashes."""
    if len(words) < size:
        return gram_hashes(words, len(words)) * np.uint64(2 * len(words) + 1)
    return distinct(gram_hashes(words, size))


def prefix_length(n: int) -> int:
    """How many of the first tokens two similar sets can't both avoid sharing."""
    return n - math.ceil(n * PERCENT / 100) + 1 if n else 0


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, np.ndarray]]:
    for doc, _, words in hashed_documents(batches, fold=True):
        yield doc, shingles(words)


def _key(tokens: np.ndarray) -> np.ndarray:
    """The two halves of a set's 128-bit key."""
    return np.frombuffer(xxhash.xxh3_128_digest(tokens.tobytes()), dtype="<i8")


def _distinct_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, np.ndarray]]:
    """The sets of a partition with the first half of their key: equal ones once, empty ones not."""
    met = set()
    for _, tokens in _sets(batches):
        key = _key(tokens)
        if len(tokens) and key.tobytes() not in met:
            met.add(key.tobytes())
            yield int(key[0]), tokens


def set_keys(docs: DataFrame) -> DataFrame:
    """_id, n_shingles and a 128-bit key (k1, k2) of every row's set; null keys for empty sets."""

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def row(doc: int, tokens: np.ndarray) -> dict[str, np.ndarray]:
            key, n = _key(tokens), np.array([len(tokens)])
            return {"_id": np.array([doc]), "n_shingles": n, "k1": key[:1], "k2": key[1:]}

        yield from batched((row(doc, tokens) for doc, tokens in _sets(batches)), 10_000)

    made = keyed(docs).mapInArrow(keys, "_id long, n_shingles long, k1 long, k2 long")
    known = lambda name: F.when(F.col("n_shingles") > 0, F.col(name)).alias(name)
    return made.select("_id", "n_shingles", known("k1"), known("k2"))


def _tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
    return (tokens for _, tokens in _distinct_sets(batches))


def index_entries(docs: DataFrame) -> DataFrame:
    """The index: tokens t that two different sets hold, with the set's key x (k1), its size n and the
    token's place p in it.
    """
    frequent = frequent_tokens(docs, _tokens)

    def prefix(key: int, tokens: np.ndarray) -> dict[str, np.ndarray]:
        seen = frequent.seen(tokens)
        first = np.lexsort((tokens, seen))[: prefix_length(len(tokens))]
        parts = frequent.parts(seen[first])
        return {
            "t": tokens[first].view(np.int64),
            "x": np.full(len(first), key, dtype=np.int64),
            "n": np.full(len(first), len(tokens), dtype=np.int32),
            "p": np.arange(len(first), dtype=np.int32),
            "part": (key % parts).astype(np.int32),
            "keep": parts > 1,
        }

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from batched(prefix(key, tokens) for key, tokens in _distinct_sets(batches))

    columns = "t long, x long, n int, p int, part int, keep boolean"
    return stored(shared_only(keyed(docs).mapInArrow(emit, columns), "x").drop("part", "keep"))


def meetings(entries: DataFrame) -> DataFrame:
    """x and `at`, the meetings (leader, i, j) its set has to be at.

    With p tokens before the first that two sets have in common, their symmetric difference is at
    least the sum of both p; similar sets allow it (100 - PERCENT) / (100 + PERCENT) of the sum of
    their sizes. `room` is what is left of that. Dropped tokens after the first common one may be
    further back in the other set, so they count for nothing but the choice of the leader.
    """
    indexed = F.col("n") - F.ceil(F.col("n") * PERCENT / 100) + 1
    own = indexed - F.count(F.lit(1)).over(Window.partitionBy("x", "n"))
    room = (100 - PERCENT) * F.col("n") - (100 + PERCENT) * F.col("p")
    placed = checkpointed(
        entries.select("t", "x", "n", room.alias("room"), (own / F.col("n")).alias("own"))
    )
    lists = checkpointed(
        placed.groupBy("t").agg(
            F.max("room").alias("most"), F.min(F.struct("own", "x")).getField("x").alias("leader")
        )
    )
    members = (
        placed.join(lists, "t")
        .where(F.col("room") + F.col("most") >= 0)
        .groupBy("leader", "x")
        .agg(F.max("n").alias("n"))
    )
    return invitations(members)


def invitations(members: DataFrame) -> DataFrame:
    """x and `at`, the meetings (leader, i, j) of its chunk of every group (leader, x, n) it is in."""
    members = checkpointed(members)
    chunks = F.greatest(F.ceil(F.col("size") / MEETING), F.ceil(F.col("tokens") / MEETING_TOKENS))
    sizes = checkpointed(
        members.groupBy("leader")
        .agg(F.count(F.lit(1)).alias("size"), F.sum("n").alias("tokens"))
        .where(F.col("size") > 1)
        .select("leader", chunks.alias("chunks"))
    )
    own_chunk = F.pmod(F.xxhash64("x", "leader"), F.col("chunks"))
    met = members.join(sizes, "leader").select(
        "x",
        "leader",
        own_chunk.alias("c"),
        F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("chunks") - 1)).alias("o"),
    )
    place = F.struct("leader", F.least("c", "o").alias("i"), F.greatest("c", "o").alias("j"))
    return checkpointed(met.groupBy("x").agg(F.collect_list(place).alias("at")))


def overlaps(sets: list[np.ndarray]) -> np.ndarray:
    """How many tokens each two of the sets share, as a matrix; its diagonal is of no use."""
    sizes = np.array([len(s) for s in sets])
    tokens, at, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    row = np.repeat(np.arange(len(sets)), sizes)
    column = (np.cumsum(times > 1) - 1)[at]
    usable = (times > 1)[at]  # tokens of one set only are not counted
    row, column = row[usable], column[usable]
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    shared = np.zeros((len(sets), len(sets)))
    for start in range(0, int((times > 1).sum()), COLUMNS):
        a, b = np.searchsorted(column, [start, start + COLUMNS])
        part = np.zeros((len(sets), COLUMNS), dtype=np.float32)
        part[row[a:b], column[a:b] - start] = 1
        shared += part @ part.T
    return shared


def _alike(shared: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    alike = 100 * shared >= PERCENT * (sizes[:, None] + sizes[None, :] - shared)
    np.fill_diagonal(alike, True)
    return alike


def similar(sets: list[np.ndarray]) -> np.ndarray:
    """Which of the sets are similar, as a matrix."""
    return _alike(overlaps(sets), np.array([len(s) for s in sets]))


def maybe_similar(sketches: list[np.ndarray], sizes: np.ndarray) -> np.ndarray:
    """Which of the sets may be similar by their sketches; every similar pair is among these.

    Tokens that two sets share have the same short hash in both. One short hash stands for several
    tokens of a set as often as the set has fewer short hashes than tokens, so what the sketches
    share and that number bound what the sets share.
    """
    folded = sizes - np.array([len(s) for s in sketches])
    most = overlaps(sketches) + np.minimum(folded[:, None], folded[None, :])
    return _alike(np.minimum(most, np.minimum(sizes[:, None], sizes[None, :])), sizes)


def sketch(tokens: np.ndarray) -> np.ndarray:
    """The distinct short hashes of a set, a quarter of its size or less."""
    return np.unique((tokens >> np.uint64(48)).astype(np.uint16))


def _one_link_each(docs: np.ndarray, alike: np.ndarray) -> pa.Table:
    """One link per member of a class found here, to its smallest member."""
    least = docs.copy()
    while True:
        spread = np.where(alike, least[None, :], np.iinfo(np.int64).max).min(axis=1)
        if (spread == least).all():
            break
        least = spread
    return pa.table({"u": docs[docs != least], "v": least[docs != least]})


def _meet(table: pa.Table) -> pa.Table:
    sets = [np.frombuffer(s, dtype=np.uint64) for s in table["tokens"].to_pylist()]
    return _one_link_each(table["x"].to_numpy(), similar(sets))


def _meet_roughly(table: pa.Table) -> pa.Table:
    sketches = [np.frombuffer(s, dtype=np.uint16) for s in table["tokens"].to_pylist()]
    return _one_link_each(table["x"].to_numpy(), maybe_similar(sketches, table["n"].to_numpy()))


def _gathered(docs: DataFrame, invited: DataFrame, roughly: bool) -> DataFrame:
    """The links found at the meetings (x, at), to which sets come whole or as sketches."""

    def bring(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for (doc, tokens), at in zip(_sets(iter([batch])), batch.column("at").to_pylist()):
                if len(tokens):
                    brought = (sketch(tokens) if roughly else tokens).tobytes()
                    yield pa.record_batch(
                        {name: pa.array([a[name] for a in at], pa.int64()) for name in ("leader", "i", "j")}
                        | {
                            "x": pa.array([doc] * len(at), pa.int64()),
                            "n": pa.array([len(tokens)] * len(at), pa.int64()),
                            "tokens": pa.array([brought] * len(at), pa.binary()),
                        }
                    )

    guests = keyed(docs).join(invited, F.col("_id") == F.col("x")).select("_id", "_th", "_text", "at")
    brought = guests.mapInArrow(bring, "leader long, i long, j long, x long, n long, tokens binary")
    meet = _meet_roughly if roughly else _meet
    return brought.groupBy("leader", "i", "j").applyInArrow(meet, "u long, v long")


def links(docs: DataFrame, equal: DataFrame) -> DataFrame:
    """u and v: enough pairs of similar documents to connect all that are similar.

    `equal` has the key (k1, k2) of every set, its size n and the first document with it, which
    stands for all. To the meetings of the index come sketches; what they leave possible falls into
    groups, and a whole set is sent to its one group only.
    """
    entries = index_entries(docs)
    met = meetings(entries)
    discard(entries)
    firsts = equal.select("k1", F.col("first").alias("x"))
    invited = checkpointed(met.join(firsts, met["x"] == firsts["k1"]).select(firsts["x"], "at"))
    possible = components(_gathered(docs, invited, roughly=True))
    release(docs.sparkSession)
    members = possible.select(F.col("v").alias("leader"), F.col("u").alias("x"))
    heads = possible.select(F.col("v").alias("leader"), F.col("v").alias("x")).distinct()
    sizes = equal.select(F.col("first").alias("x"), "n")
    grouped = members.union(heads).join(sizes, "x")
    return _gathered(docs, invitations(grouped.select("leader", "x", "n")), roughly=False)


def classes(docs: DataFrame) -> DataFrame:
    """Per row: _id, n_shingles and component, the smallest id it is connected with."""
    keys = checkpointed(set_keys(docs))
    equal = checkpointed(
        keys.where(F.col("k1").isNotNull()).groupBy("k1", "k2").agg(
            F.min("_id").alias("first"), F.max("n_shingles").alias("n")
        )
    )
    copies = keys.join(equal, ["k1", "k2"]).select(F.col("_id").alias("u"), F.col("first").alias("v"))
    found = components(copies.union(links(docs, equal)))
    release(docs.sparkSession)
    joined = keys.join(found, keys["_id"] == found["u"], "left")
    return joined.select("_id", "n_shingles", F.coalesce("v", "_id").alias("component"))


def class_report(docs: DataFrame) -> DataFrame:
    return classes(docs).select(given_id(), "n_shingles", given_id("component", "component_id"))


def keep_one(docs: DataFrame) -> DataFrame:
    """The documents, of each class only the one with the smallest id.

    Rows that agree in id and text are one document, and so are rows without an id that agree in
    text: one of them stays, the first by its JSON.
    """
    gone = checkpointed(classes(docs).where(F.col("component") != F.col("_id")).select("_id").distinct())
    rows = with_key(docs)
    row = ["_id", "_th"]
    repeated = checkpointed(rows.groupBy(*row).agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(*row))
    kept = rows.join(small_enough(gone), "_id", "left_anti")
    single = kept.join(small_enough(repeated), row, "left_anti").select("_row.*")
    if repeated.isEmpty():
        return single
    again = kept.join(small_enough(repeated), row, "left_semi")
    one = again.groupBy(*row).agg(F.min_by("_row", F.to_json("_row")).alias("_row"))
    return single.unionByName(one.select("_row.*"))
