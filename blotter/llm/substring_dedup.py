"""Substring dedup: words in passages of `WINDOW` words that begin anywhere else are removed.

Shards by content. A window belongs to the smallest of its 5-word hashes (frequent ones count as
large); equal windows have equal owners. Neighbouring windows of one owner make a segment. Owners
that only one segment has can't repeat and are dropped; the segments of the others are cut from
the texts, equal ones made one with a count, and sent to the shard of their owner. So every
occurrence of a window meets in one shard, a document goes only where it may match, and the
work grows with the text, not with documents times shards.

Index per shard. A shard's segments make a compressed FM-index (see fm_index). They are streamed
through it by backward search, which gives their matching statistics; windows that reach the
threshold elsewhere are reported as intervals and brought back to the documents.

A shard takes whole owners up to `SHARD_WORDS`. The windows of an owner with more are dealt out
singly by their hash, so that none of an index's inputs grows without bound.

Defined cases: a null or empty text has no words. Repeated rows are occurrences of each other, so
all their windows repeat. Rows with the same id and other texts are told apart by text; a null id is an id.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from blotter.llm.common import checkpointed, given_id, keyed, small_enough, stored, with_key
from blotter.llm.fm_index import FmIndex
from blotter.llm.tokens import (
    PORTION,
    Frequent,
    batched,
    distinct,
    frequent_tokens,
    gram_hashes,
    hashed_documents,
    shared_only,
)

WINDOW = 35
GRAM = 5
SHARD_WORDS = 200_000
OWNER_WORDS = 2_000_000


def _tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
    for _, _, words in hashed_documents(batches, fold=False):
        if len(words) >= WINDOW:
            yield distinct(gram_hashes(words, GRAM))


def smallest(values: np.ndarray, span: int) -> np.ndarray:
    """The smallest of every `span` neighbouring values, from windows of twice the width each time."""
    width = 1
    while width < span:
        by = min(width, span - width)
        values = np.minimum(values[:-by], values[by:])
        width += by
    return values


def segments(
    grams: np.ndarray, frequent: Frequent, doc: int = 0, window: int = WINDOW, gram: int = GRAM
) -> dict[str, np.ndarray]:
    """Runs of windows with one owner: the owner t, first and last window, part and keep.

    `keep` marks what may repeat without another segment of its owner in the same part: owners
    dealt out in parts, and runs in which the owner stands more than once.
    """
    seen = frequent.seen(grams)
    order = grams >> np.uint64(6)
    common = np.flatnonzero(seen)
    level = np.minimum(np.ceil(np.log2(seen[common] + 1)), 63).astype(np.uint64)
    order[common] |= level << np.uint64(58)
    span = window - gram + 1
    owner = smallest(order, span)
    first = np.concatenate([[0], np.flatnonzero(owner[1:] != owner[:-1]) + 1])
    # Runs longer than a span are cut, so that a segment has a bounded length.
    inside = np.arange(len(owner)) - np.repeat(first, np.diff(np.append(first, len(owner))))
    first = np.flatnonzero(inside % span == 0)
    last = np.append(first[1:], len(owner)) - 1
    inner = np.arange(span)
    place_first = order[first[:, None] + inner].argmin(axis=1) + first
    place_last = order[last[:, None] + inner].argmin(axis=1) + last
    parts = frequent.parts(seen[place_first])
    return {
        "t": owner[first].view(np.int64),
        "first": first.astype(np.int32),
        "last": last.astype(np.int32),
        "part": ((first + doc * 2654435761) % parts).astype(np.int32),
        "keep": (parts > 1) | (place_first != place_last),
    }


def owned_runs(docs: DataFrame) -> DataFrame:
    """_id, _th, t, first and last of every run whose owner some other run has too."""
    frequent = frequent_tokens(docs, _tokens)

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[dict[str, np.ndarray]]:
        for doc, text_hash, words in hashed_documents(batches, fold=False):
            if len(words) >= WINDOW:
                found = segments(gram_hashes(words, GRAM), frequent, doc % 65536)
                n = len(found["t"])
                yield {"_id": np.full(n, doc), "_th": np.full(n, text_hash)} | found

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from batched(runs(batches))

    columns = "_id long, _th long, t long, first int, last int, part int, keep boolean"
    return shared_only(keyed(docs).mapInArrow(emit, columns)).drop("part", "keep")


def cut_segments(docs: DataFrame) -> DataFrame:
    """Every owned run as words: _id, _th, first, its owner t, its 128-bit key and `words`."""
    lists = (
        owned_runs(docs)
        .groupBy("_id", "_th")
        .agg(F.collect_set(F.struct("first", "last", "t")).alias("runs"))
    )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("runs")
            runs, ends = lists.flatten(), np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False))
            firsts, lasts = runs.field("first").to_numpy(), runs.field("last").to_numpy()
            texts = batch.column("_text").cast(pa.binary())
            parts: list[bytes] = []
            size = begun = 0  # the first document of the batch to come

            def some(end: int) -> pa.RecordBatch:
                """The segments of the documents from `begun` to before `end`."""
                given = batch.slice(begun, end - begun)
                each = given.column("runs").value_lengths()
                own = np.repeat(np.arange(end - begun), each.to_numpy(zero_copy_only=False))
                chosen = runs.slice(ends[end - 1] - len(own), len(own))
                keys = np.frombuffer(b"".join(map(xxhash.xxh3_128_digest, parts)), dtype="<i8")
                return pa.record_batch(
                    {
                        "_id": given.column("_id").take(pa.array(own)),
                        "_th": given.column("_th").take(pa.array(own)),
                        "first": chosen.field("first"),
                        "t": chosen.field("t"),
                        "k1": pa.array(keys[::2]),
                        "k2": pa.array(keys[1::2]),
                        "words": pa.array(parts, pa.binary()),
                    }
                )

            start = 0
            for row, end in enumerate(ends.tolist()):
                words = texts[row].as_py().split()
                for first, last in zip(firsts[start:end].tolist(), lasts[start:end].tolist()):
                    parts.append(b" ".join(words[first : last + WINDOW]))
                    size += len(parts[-1])
                start = end
                if size >= PORTION or row == len(ends) - 1:
                    yield some(row + 1)
                    parts, size, begun = [], 0, row + 1

    columns = "_id long, _th long, first int, t long, k1 long, k2 long, words binary"
    texts = keyed(docs).join(lists, ["_id", "_th"]).select("_id", "_th", "_text", "runs")
    return stored(texts.mapInArrow(cut, columns))


def _single_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Segments of an oversized owner become single windows, dealt out by their hash."""
    schema = None
    for batch in batches:
        schema = schema or pa.schema([f for f in batch.schema if f.name != "splits"])
        rows = []
        for row in batch.to_pylist():
            splits = row.pop("splits")
            if splits is None:
                rows.append(row)
                continue
            words = row["words"].split()
            for at in range(len(words) - WINDOW + 1):
                part = b" ".join(words[at : at + WINDOW])
                dealt = xxhash.xxh3_64_intdigest(part, seed=1) % splits
                rows.append(row | {"words": part, "at": at, "deal": dealt})
        yield pa.RecordBatch.from_pylist(rows, schema=schema)


def _search(rows: list[tuple[int, int, int, bytes, int]]) -> pa.RecordBatch:
    """Index the segments of a shard and report the intervals that repeat."""
    numbers: defaultdict[bytes, int] = defaultdict(count().__next__)
    words = b" ".join([row[3] for row in rows]).split()
    every = np.fromiter(map(numbers.__getitem__, words), dtype=np.int64, count=len(words))
    ends = np.cumsum([row[3].count(b" ") + 1 for row in rows])
    texts = np.split(every, ends[:-1])
    index = FmIndex(texts, np.array([row[4] for row in rows], dtype=np.int64), WINDOW)
    k1, k2, begin, end = [], [], [], []
    for (a, b, at, _, _), starts in zip(rows, index.repeated()):
        if len(starts):
            opens = np.concatenate([[0], np.flatnonzero(np.diff(starts) > 1) + 1])
            closes = np.append(opens[1:], len(starts)) - 1
            for o, c in zip(opens, closes):
                k1.append(a)
                k2.append(b)
                begin.append(at + int(starts[o]))
                end.append(at + int(starts[c]) + WINDOW)
    return pa.record_batch(
        {
            "k1": pa.array(k1, pa.int64()),
            "k2": pa.array(k2, pa.int64()),
            "begin": pa.array(begin, pa.int32()),
            "end": pa.array(end, pa.int32()),
        }
    )


def _shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Whole owners, in order, up to SHARD_WORDS at a time."""
    held: list[tuple[int, int, int, bytes, int]] = []
    size, owner = 0, None
    for batch in batches:
        names = ("t", "deal", "k1", "k2", "at", "words", "times")
        for t, deal, *row in zip(*(batch.column(name).to_pylist() for name in names)):
            if (t, deal) != owner:
                if size >= SHARD_WORDS:
                    yield _search(held)
                    held, size = [], 0
                owner = (t, deal)
            held.append(tuple(row))
            size += row[3].count(b" ") + 2
    if held:
        yield _search(held)


def repeated_intervals(cut: DataFrame) -> DataFrame:
    """k1, k2, begin and end: where the words of a segment repeat, by word number in it."""
    n_words = F.length(F.col("words").cast("string")) - F.length(
        F.replace(F.col("words").cast("string"), F.lit(" "), F.lit(""))
    ) + 1
    distinct = stored(
        cut.groupBy("t", "k1", "k2", "words").agg(F.count(F.lit(1)).alias("times"))
    )
    large = checkpointed(
        distinct.groupBy("t").agg(F.sum(n_words).alias("n")).where(F.col("n") > OWNER_WORDS)
        .select("t", F.ceil(F.col("n") * WINDOW / OWNER_WORDS).alias("splits"))
    )
    rows = distinct.join(small_enough(large), "t", "left").select(
        "t", F.lit(0).cast("bigint").alias("deal"), "k1", "k2",
        F.lit(0).alias("at"), "words", "times", "splits",
    )
    columns = "t long, deal long, k1 long, k2 long, at int, words binary, times long"
    dealt = rows.mapInArrow(_single_windows, columns)
    by_owner = dealt.repartition("t", "deal").sortWithinPartitions("t", "deal")
    return by_owner.mapInArrow(_shards, "k1 long, k2 long, begin int, end int")


def repeats(docs: DataFrame) -> DataFrame:
    """_id, _th and `lost`, the word intervals (begin, end) to remove; documents with any only."""
    cut = cut_segments(docs)
    found = stored(repeated_intervals(cut))
    joined = cut.select("_id", "_th", "first", "k1", "k2").join(found, ["k1", "k2"])
    interval = F.struct(
        (F.col("first") + F.col("begin")).alias("begin"), (F.col("first") + F.col("end")).alias("end")
    )
    return joined.groupBy("_id", "_th").agg(F.collect_set(interval).alias("lost"))


def _kept(texts: pd.Series, lost: pd.Series) -> pd.DataFrame:
    out = []
    for text, intervals in zip(texts, lost):
        words = text.encode().split()
        if intervals is not None:
            edges = np.zeros(len(words) + 1, dtype=np.int64)
            for interval in intervals:
                edges[interval["begin"]] += 1
                edges[interval["end"]] -= 1
            stays = np.cumsum(edges[:-1]) == 0
            left = [word for word, stay in zip(words, stays) if stay]
        else:
            left = words
        out.append((len(words), len(words) - len(left), b" ".join(left).decode()))
    return pd.DataFrame(out, columns=["n_words", "n_removed", "kept"])


def without_repeats(docs: DataFrame) -> DataFrame:
    """`_row` (the document as given), _id, n_words, n_removed and `kept`, its words joined by spaces."""
    kept = F.pandas_udf(_kept, "n_words long, n_removed long, kept string")
    joined = with_key(docs).join(repeats(docs), ["_id", "_th"], "left")
    text = F.coalesce(F.col("_row.text"), F.lit(""))
    return joined.select("_row", "_id", kept(text, F.col("lost")).alias("k")).select("_row", "_id", "k.*")


def substring_report(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, n_words, n_removed and the SHA-256 of the words that stay."""
    texts = docs.select("doc_id", "text")
    return without_repeats(texts).select(
        given_id(), "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256")
    )


def remove_repeats(docs: DataFrame) -> DataFrame:
    """The documents with repeated passages cut; texts without any stay as they are."""
    done = without_repeats(docs)
    cut = F.col("n_removed") > 0
    new = {"text": F.when(cut, F.col("kept")).otherwise(F.col("_row.text"))}
    if "n_chars" in docs.columns:
        length = F.length("kept").cast(docs.schema["n_chars"].dataType)
        new["n_chars"] = F.when(cut, length).otherwise(F.col("_row.n_chars"))
    return done.select(
        *[new.get(name, F.col("_row").getField(name)).alias(name) for name in docs.columns]
    )
