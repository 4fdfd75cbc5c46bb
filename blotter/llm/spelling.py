"""Groups of spelling variants: words that differ by one code point, rarer ones led to frequent ones.

1. Every task counts the words of its texts, and the counts are summed up.
2. The vocabulary is cut into shards in which near words must meet. Of two words whose shorter one has c
   letters, the one difference lies in the first c // 2 letters or after them, so they agree in the
   rest at their end or in those at their start: a shard holds the words of c or c + 1 letters
   that agree in one of the two. A word is in four kinds of shards. Large shards are cut into chunks of
   which each meets each.
3. A chunk is indexed bit by bit: for each position and letter, one bitset of the words that have it
   there. A word is looked up letter by letter, all words of the chunk at once, with three recurrences
   beside each other: what agrees so far without an error, and with one letter replaced, or one more
   or less, where the index is read one position further or back. A pair that agrees at its start is
   left to the shards of starts, so it is found once.
4. A chunk answers with the number of near words and the most frequent one per word, not with pairs.
5. Forms are followed to their ends by pointer doubling; an end has the form of no other word's.

Defined cases: null and empty texts have no words. A null id counts as an empty text before the colon.
Rows are taken one by one, so repeated rows count again. Extra columns don't matter. Without words
the result is empty.
"""

from __future__ import annotations

import re
import zlib
from collections import defaultdict
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from blotter.llm.common import checkpointed, stored

LEAST_LETTERS = 7
LEAST_TIMES = 2
# A form is at least so many times as frequent as its word.
FREQUENT = 10
# One word occurrence in DAMAGED loses a letter.
DAMAGED = 31

# Distinct words a task counts before it hands them on.
MOST_WORDS = 300_000
# Words of a chunk: bits of a bitset.
CHUNK = 4096

# Words as single bytes: Latin-1 has all their letters and no other text becomes one.
_RUN = re.compile(rb"[A-Za-z\xC0-\xFF]{%d,}" % LEAST_LETTERS)


def words_of(doc_id: int | None, text: str) -> Iterator[bytes]:
    """The words of a text in Latin-1, A-Z lower-cased, some damaged by the rule of their checksum."""
    start = zlib.crc32(b":" if doc_id is None else b"%d:" % doc_id)
    for run in _RUN.findall(text.encode("latin-1", "replace")):
        run = run.lower()
        shown = run if run.isascii() else run.decode("latin-1").encode()
        h = zlib.crc32(shown, start)
        if h % DAMAGED == 0:
            at = h % len(run)
            run = run[:at] + run[at + 1 :]
            if len(run) < LEAST_LETTERS:
                continue
        yield run


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: dict[bytes, int] = defaultdict(int)

    def counted() -> pa.RecordBatch:
        words = [word.decode("latin-1") for word in counts]
        return pa.record_batch(
            {"word": pa.array(words, pa.string()), "n": pa.array(counts.values(), pa.int64())}
        )

    for batch in batches:
        for doc_id, text in zip(batch.column("_id").to_pylist(), batch.column("_text")):
            for word in words_of(doc_id, text.as_py()):
                counts[word] += 1
            if len(counts) >= MOST_WORDS:
                yield counted()
                counts.clear()
    if counts:
        yield counted()


def vocabulary(docs: DataFrame) -> DataFrame:
    """word and n, its occurrences."""
    texts = docs.select(F.col("doc_id").cast("bigint").alias("_id"), F.col("text").alias("_text")).where(
        F.length("_text") >= LEAST_LETTERS
    )
    counted = texts.mapInArrow(_count, "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= LEAST_TIMES)


# ---- shards --------------------------------------------------------------------------------


def _shards(word: Column) -> Column:
    """The shards of a word: the shorter length c, the side that agrees, and what agrees there."""

    def shard(c: Column, start: bool) -> Column:
        half = F.floor(c / 2).cast("int")
        part = F.left(word, half) if start else F.right(word, c - half)
        return F.when(c >= LEAST_LETTERS, F.struct(c.alias("c"), F.lit(start).alias("start"), part.alias("part")))

    n = F.length(word)
    return F.array_compact(F.array(*[shard(c, start) for c in (n, n - 1) for start in (True, False)]))


class Index:
    """A bit-sliced index of words: bit v of a bitset stands for the v-th word."""

    def __init__(self, words: Sequence[str]) -> None:
        self.words = words
        self._at: dict[tuple[int, str], int] = defaultdict(int)
        self._long: dict[int, int] = defaultdict(int)
        bit = 1
        for word in words:
            for place in enumerate(word):
                self._at[place] |= bit
            self._long[len(word)] |= bit
            bit <<= 1
        self._all = bit - 1

    def near(self, word: str, c: int) -> int:
        """The bitset of the words that differ from `word` by one code point, the shorter having c."""
        at = self._at.get
        same = self._all  # no error so far
        replaced = 0  # one letter replaced
        longer = 0  # they have one letter more: read one position further
        shorter = 0  # they have one letter less: read one position back
        for place, letter in enumerate(word):
            here = at((place, letter), 0)
            longer = (longer | same) & at((place + 1, letter), 0)
            shorter = shorter & at((place - 1, letter), 0) | same
            replaced = replaced & here | same & ~here
            same &= here
            if not (same | replaced | longer | shorter):
                return 0
        have = self._long.get
        if len(word) > c:
            return shorter & have(c, 0)
        return replaced & have(c, 0) | (longer | same) & have(c + 1, 0)


def _places(bits: int) -> Iterator[int]:
    while bits:
        low = bits & -bits
        yield low.bit_length() - 1
        bits ^= low


def _meet(words: list[str], times: list[int], chunks: list[int], key: tuple) -> dict[int, list]:
    """Per word with near words: how many, and the count and place of the most frequent of them.

    The words of chunk i are indexed and those of chunk j looked up. If it is another chunk, what they
    find is an answer for both.
    """
    c, start, _, i, j = key
    indexed = [v for v, chunk in enumerate(chunks) if chunk == i]
    asked = [v for v, chunk in enumerate(chunks) if chunk == j]
    index = Index([words[v] for v in indexed])
    half = c // 2
    found: dict[int, list] = {}

    def note(v: int, u: int) -> None:
        best = found.setdefault(v, [0, 0, u])
        best[0] += 1
        if times[u] > best[1] or times[u] == best[1] and words[u] < words[best[2]]:
            best[1:] = times[u], u

    for v in asked:
        for bit in _places(index.near(words[v], c)):
            u = indexed[bit]
            if not start and words[v][:half] == words[u][:half]:
                continue  # the shard of starts has this pair
            note(v, u)
            if i != j:
                note(u, v)
    return found


_FOUND = "word string, n_near long, best_n long, best string"


def _search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Shards, sorted, to the partial answers of their words."""
    out: dict[str, list] = {"word": [], "n_near": [], "best_n": [], "best": []}

    def ready() -> pa.RecordBatch:
        kinds = (pa.string(), pa.int64(), pa.int64(), pa.string())
        batch = pa.record_batch({k: pa.array(v, kind) for (k, v), kind in zip(out.items(), kinds)})
        for values in out.values():
            values.clear()
        return batch

    def close() -> None:
        for v, (near, best_n, u) in _meet(words, times, chunks, key).items():
            for values, value in zip(out.values(), (words[v], near, best_n, words[u])):
                values.append(value)

    key, words, times, chunks = None, [], [], []
    for batch in batches:
        columns = [batch.column(name).to_pylist() for name in ("c", "start", "part", "i", "j")]
        rest = [batch.column(name).to_pylist() for name in ("word", "n", "own")]
        for own_key, word, n, own in zip(zip(*columns), *rest):
            if own_key != key:
                if len(words) > 1:
                    close()
                key, words, times, chunks = own_key, [], [], []
            words.append(word)
            times.append(n)
            chunks.append(own)
        if len(out["word"]) > 10_000:
            yield ready()
    if len(words) > 1:
        close()
    if out["word"]:
        yield ready()


def near_words(words: DataFrame) -> DataFrame:
    """Per word that has any: n_near, and best_n and best, its most frequent near word."""
    placed = words.select("word", "n", F.explode(_shards(F.col("word"))).alias("s")).select("word", "n", "s.*")
    sizes = (
        placed.groupBy("c", "start", "part").agg(F.count(F.lit(1)).alias("size")).where(F.col("size") > 1)
    )
    sized = placed.join(sizes, ["c", "start", "part"])
    chunks = F.ceil(F.col("size") / CHUNK)
    own = F.pmod(F.xxhash64("word"), chunks)
    others = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("chunks") - 1)).alias("o")
    met = sized.select("c", "start", "part", "word", "n", own.alias("own"), chunks.alias("chunks")).select(
        "c", "start", "part", "word", "n", "own", others
    )
    pairs = met.select(
        "c", "start", "part", F.least("own", "o").alias("i"), F.greatest("own", "o").alias("j"), "word", "n", "own"
    )
    keys = ["c", "start", "part", "i", "j"]
    dealt = pairs.repartition(*keys).sortWithinPartitions(*keys)
    # The largest count first, then the smallest word.
    rank = F.struct((-F.col("best_n")).alias("less"), "best")
    best = dealt.mapInArrow(_search, _FOUND).groupBy("word").agg(
        F.sum("n_near").alias("n_near"), F.min(rank).alias("b")
    )
    return best.select("word", "n_near", (-F.col("b.less")).alias("best_n"), F.col("b.best").alias("best"))


# ---- forms ---------------------------------------------------------------------------------


def _roots(forms: DataFrame) -> DataFrame:
    """word and root from word and form. Counts grow at every step, so no form leads back."""
    state = checkpointed(forms.select("word", F.col("form").alias("root")))
    while True:
        further = state.select(F.col("word").alias("root"), F.col("root").alias("next"))
        joined = state.join(further, "root", "left")
        if joined.where(F.col("next").isNotNull()).isEmpty():
            return state
        state = checkpointed(joined.select("word", F.coalesce("next", "root").alias("root")))


def variants(docs: DataFrame) -> DataFrame:
    """Per word: word, form, root, n, n_near and form_n."""
    words = stored(vocabulary(docs))
    near = near_words(words)
    frequent = F.col("best_n") >= FREQUENT * F.col("n")
    joined = stored(
        words.join(near, "word", "left").select(
            "word",
            F.when(frequent, F.col("best")).alias("form"),
            "n",
            F.coalesce("n_near", F.lit(0).cast("bigint")).alias("n_near"),
            F.when(frequent, F.col("best_n")).alias("form_n"),
        )
    )
    roots = _roots(joined.where(F.col("form").isNotNull()))
    return joined.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
