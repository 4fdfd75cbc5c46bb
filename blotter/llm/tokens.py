"""Hashes of word n-grams, which of them are frequent, and lists of those that several rows share."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from blotter.llm.common import keyed

# One document in SAMPLE is looked at for frequent tokens. A token that COMMON of them hold counts
# as frequent; the most frequent MOST_COMMON are known to every task (16 bytes each). They decide
# the order of tokens, and so how long lists get, but never the result.
SAMPLE = 16
COMMON = 4
MOST_COMMON = 1 << 18
# A frequent token's list is dealt out in parts of about so many entries.
PART = 4096
# By its first bits a token is looked up before it is searched: 4 MB in each task.
PREFIX_BITS = 22
PREFIX_SHIFT = np.uint64(64 - PREFIX_BITS)

# Texts are hashed in portions of about so many bytes.
PORTION = 1 << 20
# Longer words are hashed singly.
LONG_WORD = 256


def _random_words(n: int) -> np.ndarray:
    """n fixed pseudo-random 64-bit numbers (the finalizer of splitmix64 over a counter)."""
    z = np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return z ^ (z >> np.uint64(31))


_RANDOM = _random_words(256 + LONG_WORD)
_IS_SPACE = np.zeros(256, dtype=bool)
_IS_SPACE[list(b" \t\n\x0b\x0c\r")] = True
_FOLDED = np.arange(256, dtype=np.uint8)
_FOLDED[65:91] += 32  # A-Z
_MIX = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xFF51AFD7ED558CCD))


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * _MIX[1]
    return h ^ (h >> np.uint64(29))


def word_hashes(texts: list[bytes], fold: bool) -> list[np.ndarray]:
    """Per text the 64-bit hashes of its words, in order; with `fold` A-Z counts as a-z.

    All words at once: a byte's random number times that of its place in the word, summed up.
    """
    raw = np.frombuffer(b"\n".join([*texts, b""]), dtype=np.uint8)
    in_word = ~_IS_SPACE[raw]
    turns = np.flatnonzero(in_word[1:] != in_word[:-1]) + 1
    if len(raw) and in_word[0]:
        turns = np.concatenate([[0], turns])
    starts, ends = turns[::2], turns[1::2]
    lengths = ends - starts
    chars = raw[in_word]
    if fold:
        chars = _FOLDED[chars]
    first = np.cumsum(lengths) - lengths
    place = np.arange(len(chars)) - np.repeat(first, lengths)
    odd = _RANDOM[256 + np.minimum(place, LONG_WORD - 1)] | np.uint64(1)
    values = _mixed(_RANDOM[chars] * odd)
    hashes = np.add.reduceat(values, first) if len(first) else np.empty(0, np.uint64)
    hashes = _mixed(hashes + lengths.astype(np.uint64) * _MIX[0])
    for long in np.flatnonzero(lengths > LONG_WORD):
        word = chars[first[long] : first[long] + lengths[long]].tobytes()
        hashes[long] = xxhash.xxh3_64_intdigest(word)
    text_ends = np.cumsum([len(text) + 1 for text in texts])
    return np.split(hashes, np.searchsorted(starts, text_ends[:-1])) if texts else []


def hashed_documents(
    batches: Iterator[pa.RecordBatch], fold: bool
) -> Iterator[tuple[int, int, np.ndarray]]:
    """_id, _th and the word hashes of every document."""
    for batch in batches:
        names = zip(batch.column("_id").to_pylist(), batch.column("_th").to_pylist())
        texts = batch.column("_text").cast(pa.binary())
        part: list[bytes] = []
        size = 0
        for row, text in enumerate(texts):
            part.append(text.as_py())
            size += len(part[-1])
            if size >= PORTION or row == len(texts) - 1:
                for hashes in word_hashes(part, fold):
                    yield *next(names), hashes
                part, size = [], 0


def gram_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """The 64-bit hash of every run of `size` words, in order, from the words' hashes."""
    n = max(len(words) - size + 1, 0)
    mixed = words[:n].copy()
    for place in range(1, size):
        mixed *= _MIX[0]
        mixed ^= mixed >> np.uint64(29)
        mixed += words[place : place + n]
    mixed *= _MIX[1]
    mixed ^= mixed >> np.uint64(32)
    return mixed


def distinct(hashes: np.ndarray) -> np.ndarray:
    """The distinct hashes in order."""
    hashes = np.sort(hashes)
    return hashes[np.append(True, hashes[1:] != hashes[:-1])] if len(hashes) else hashes


def batched(rows: Iterator[dict[str, np.ndarray]], size: int = 200_000) -> Iterator[pa.RecordBatch]:
    """Groups of rows, each a column by name, as batches of about `size` rows."""
    held: list[dict[str, np.ndarray]] = []
    count = 0
    for row in rows:
        held.append(row)
        count += len(next(iter(row.values())))
        if count >= size:
            yield pa.record_batch({k: np.concatenate([r[k] for r in held]) for k in row})
            held, count = [], 0
    if held:
        yield pa.record_batch({k: np.concatenate([r[k] for r in held]) for k in held[0]})


@dataclass(frozen=True)
class Frequent:
    tokens: np.ndarray  # sorted
    times: np.ndarray  # in how many sampled documents
    part: float = PART / SAMPLE  # samples per part of a list

    def seen(self, tokens: np.ndarray) -> np.ndarray:
        """How often each token was sampled, 0 for a token that isn't frequent."""
        if not len(self.tokens):
            return np.zeros(len(tokens), dtype=np.int64)
        # Most tokens aren't frequent, which their first bits tell without a search.
        maybe = np.flatnonzero(self.begins[tokens >> PREFIX_SHIFT])
        tokens, seen = tokens[maybe], np.zeros(len(tokens), dtype=np.int64)
        place = np.minimum(np.searchsorted(self.tokens, tokens), len(self.tokens) - 1)
        seen[maybe] = np.where(self.tokens[place] == tokens, self.times[place], 0)
        return seen

    @cached_property
    def begins(self) -> np.ndarray:
        """Which first bits the tokens have."""
        begins = np.zeros(1 << PREFIX_BITS, dtype=bool)
        begins[self.tokens >> PREFIX_SHIFT] = True
        return begins

    def parts(self, seen: np.ndarray) -> np.ndarray:
        """Into how many parts the list of a token seen so often is dealt."""
        return 1 + (seen / self.part).astype(np.int64)


def frequent_tokens(
    docs: DataFrame, tokens_of: Callable[[Iterator[pa.RecordBatch]], Iterator[np.ndarray]]
) -> Frequent:
    """At most MOST_COMMON tokens. `tokens_of` gives the distinct tokens of every document."""

    def explode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from batched({"t": tokens.view(np.int64)} for tokens in tokens_of(batches))

    sample = keyed(docs).where(F.pmod(F.xxhash64("_id"), F.lit(SAMPLE)) == 0)
    counts = sample.mapInArrow(explode, "t long").groupBy("t").agg(F.count(F.lit(1)).alias("n"))
    rows = counts.where(F.col("n") >= COMMON).orderBy(F.desc("n"), "t").limit(MOST_COMMON).collect()
    tokens = np.array([r.t for r in rows], dtype=np.int64).view(np.uint64)
    times = np.array([r.n for r in rows], dtype=np.int64)
    order = np.argsort(tokens)
    return Frequent(tokens[order], times[order], PART / SAMPLE)


def shared_only(rows: DataFrame, once: str | None = None) -> DataFrame:
    """The rows whose token t another row has too, and all rows marked `keep`.

    A list that is dealt out in parts is a long one; its rows come marked. Rows of a list that
    agree in the column `once` are one.
    """
    order = ["t"] if once is None else ["t", once]
    lists = rows.repartition("t", "part").sortWithinPartitions(*order)

    def not_alone(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, last_shared = None, False  # a batch's last row waits for what follows
        for batch in batches:
            if batch.num_rows == 0:
                continue
            table = pa.Table.from_batches([batch] if last is None else [last, batch])
            t = table["t"].to_numpy()
            same = t[1:] == t[:-1]
            if once is not None:
                names = table[once].to_numpy()
                again = same & (names[1:] == names[:-1])
                table = table.filter(pa.array(np.append(True, ~again)))
                t = table["t"].to_numpy()
                same = t[1:] == t[:-1]
            as_before = np.append([last_shared], same)
            shared = as_before | table["keep"].to_numpy()
            shared[:-1] |= same
            end = len(table) - 1
            yield from table.slice(0, end).filter(pa.array(shared[:-1])).to_batches()
            last, last_shared = table.slice(end).combine_chunks().to_batches()[0], bool(shared[-1])
        if last is not None and last_shared:
            yield last

    return lists.mapInArrow(not_alone, rows.schema)
