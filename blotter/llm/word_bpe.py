"""BPE with word ends: encoding as a streaming transducer with bounded lookahead, and decoding.

Lookahead. Two texts that agree up to a place can be merged differently before it only through a
chain of merges that reaches back from there. Between the last boundary that both have and the
place, one has a piece y and the other a different one; a merge (x, y) moves the boundary back by
the length of x and leaves x in one and xy in the other, and a merge (y, c) turns y into yc. Every
link of such a chain comes later in the merge list than the one before, so one pass over the list
from its end gives the longest reach of each piece, and the longest of all is the lookahead. This
needs a proper list: a token is made by one merge only, after those that make its parts.

Encoding. Text comes in portions that end at white space, so no word is cut; a run without white
space that is longer than a portion is fed in parts. A word's symbols are merged in a window: what
ends at least the lookahead before the window's end is stable whatever follows, so it is emitted and
dropped. A word's last symbol is another one than inside a word, so one symbol is always held back.
The state is a portion and a window, however long text and word are. Words of usual length that were
met before are looked up in a table of bounded size.

Decoding. Ids come in portions too; the bytes of their pieces run through a byte-to-text machine that
keeps the bytes of an unfinished character. `decode` gives what the library gives for a tokenizer
without a decoder, the visible pieces with spaces between; `plain_text` gives text with spaces for
word ends, and U+FFFD for bytes that are no UTF-8.

Strings of the special tokens are those tokens. What counts as a letter or a number, and how text is
composed and lower-cased, is the tokenizer's own choice: texts beyond ASCII are normalized by it, and
where a character of the text is classified otherwise by `regex`, it splits that portion too.

Defined cases: a null or empty text, and one of white space only, has no tokens and decodes to
nothing. Every row is encoded for itself, so repeated rows and ids, null ids too, give a row each.
Columns other than doc_id and text don't matter. An empty table gives an empty one.
"""

from __future__ import annotations

import codecs
import heapq
import json
import struct
import unicodedata
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from functools import cached_property, lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from blotter.llm.common import NULL_ID, given_id

# Characters that are normalized and split at once.
PORTION = 1 << 16
# Ids that are decoded at once.
IDS = 1 << 16
# Words of up to so many bytes are looked up; a worker forgets them when they are so many.
WORD_BYTES = 64
MOST_WORDS = 400_000
# So many symbols are merged with a heap instead of pass by pass.
LONG = 40
# A word that reaches over the end of a portion with more characters than this is fed in parts.
OPEN = 1 << 10

_CONTRACTED = 3  # characters of the longest contraction


class ImproperMerges(ValueError):
    """The merge list has no bounded lookahead by the rule above."""


def visible_bytes() -> list[str]:
    """The character that stands for each byte in a byte-level vocabulary."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    shown = {b: chr(b) for b in plain}
    others = [b for b in range(256) if b not in shown]
    shown |= {b: chr(256 + n) for n, b in enumerate(others)}
    return [shown[b] for b in range(256)]


def lookahead(merges: list[tuple[str, str]], length: Callable[[str], int]) -> int:
    """How many symbols after a boundary settle it, whatever follows them."""
    made: dict[str, int] = {}
    for rank, (x, y) in enumerate(merges):
        if x + y in made:
            raise ImproperMerges(f"two merges make {x + y!r}")
        made[x + y] = rank
    for rank, (x, y) in enumerate(merges):
        if max(made.get(x, -1), made.get(y, -1)) >= rank:
            raise ImproperMerges(f"{x!r} and {y!r} are merged before one of them is made")
    reach: dict[str, int] = {}
    for x, y in reversed(merges):
        grown = max(reach.get(x, 0), reach.get(x + y, 0))
        reach[y] = max(reach.get(y, 0), length(x) + grown)
        reach[x] = grown
    return max(reach.values(), default=0) + 1


@dataclass(frozen=True)
class Vocabulary:
    """A word-end BPE tokenizer as its file describes it."""

    config: str

    @cached_property
    def _parsed(self) -> dict:
        return json.loads(self.config)

    @cached_property
    def end(self) -> str:
        return self._parsed["model"]["end_of_word_suffix"]

    @cached_property
    def merges(self) -> list[tuple[str, str]]:
        return [tuple(pair) for pair in self._parsed["model"]["merges"]]

    @cached_property
    def special(self) -> dict[str, int]:
        return {token["content"]: token["id"] for token in self._parsed["added_tokens"]}

    @cached_property
    def ids(self) -> dict[str, int]:
        return self._parsed["model"]["vocab"]

    @cached_property
    def pieces(self) -> list[str]:
        """The tokens by id, special ones included."""
        every = self.ids | self.special
        pieces = [""] * (max(every.values()) + 1)
        for piece, number in every.items():
            pieces[number] = piece
        return pieces

    @cached_property
    def lookahead(self) -> int:
        end = self.end
        return lookahead(self.merges, lambda t: len(t) - len(end) * t.endswith(end))

    @cached_property
    def inside(self) -> list[int]:
        return [self.ids[shown] for shown in visible_bytes()]

    @cached_property
    def last(self) -> list[int]:
        return [self.ids[shown + self.end] for shown in visible_bytes()]

    @cached_property
    def ranks(self) -> dict[tuple[int, int], int]:
        """The place in the merge list of each pair that merges."""
        ids = self.ids
        return {(ids[x], ids[y]): rank for rank, (x, y) in enumerate(self.merges)}

    @cached_property
    def products(self) -> list[int]:
        return [self.ids[x + y] for x, y in self.merges]

    @cached_property
    def tokenizer(self) -> Tokenizer:
        return Tokenizer.from_str(self.config)

    @cached_property
    def pattern(self) -> str:
        """The expression whose matches are the words."""
        split = self._parsed["pre_tokenizer"]["pretokenizers"][0]
        return split["pattern"]["Regex"]


def read_vocabulary(path: str) -> Vocabulary:
    """A tokenizer file. It is as large as a vocabulary, not as the data."""
    with open(path, encoding="utf-8") as file:
        return Vocabulary(file.read())


# Planes in which characters are assigned; private ones aside. The kind of an assigned character
# doesn't change, so only those are looked at that Python's older tables don't have yet.
_PLANES = ((0, 0xD800), (0xE000, 0x40000), (0xE0000, 0xE1000))
# A character of each kind that a word's expression tells apart, by how " a", it and "!" are split.
_KINDS = {((1, 3), (3, 4)): "a", ((1, 2), (2, 3), (3, 4)): "1", ((1, 2), (2, 4)): "!", ((1, 2), (3, 4)): " "}


@lru_cache(maxsize=8)
def odd_characters(vocabulary: Vocabulary) -> dict[int, str]:
    """The characters that the tokenizer and `regex` take for different kinds, each with a common
    character of its kind by the tokenizer. Their tables are of different versions of Unicode.
    """
    find = regex.compile(vocabulary.pattern).finditer
    theirs = vocabulary.tokenizer.pre_tokenizer.pre_tokenize_str
    width = 4
    odd: dict[int, str] = {}
    new = [c for plane in _PLANES for c in range(*plane) if unicodedata.category(chr(c)) == "Cn"]
    for start in range(0, len(new), 1 << 12):
        part = new[start : start + (1 << 12)]
        text = "".join(f" a{chr(c)}!" for c in part)
        splits = []
        for spans in ((span for _, span in theirs(text)), (m.span() for m in find(text))):
            split: dict[int, list[tuple[int, int]]] = {}
            for first, end in spans:
                at = first // width
                split.setdefault(at, []).append((first - at * width, end - at * width))
            splits.append(split)
        if splits[0] != splits[1]:
            for at, split in splits[0].items():
                if split != splits[1][at]:
                    odd[part[at]] = _KINDS[tuple(split)]
    return odd


def merged(symbols: list[int], vocabulary: Vocabulary) -> list[int]:
    """The symbols after all merges, in the order of the list and then from left to right."""
    if len(symbols) > LONG:
        return _merged_by_heap(symbols, vocabulary)
    rank, products = vocabulary.ranks.get, vocabulary.products
    none = len(products)
    symbols = list(symbols)
    ranks = [rank(pair, none) for pair in zip(symbols, symbols[1:])]
    while ranks:
        least = min(ranks)
        if least == none:
            break
        place = ranks.index(least)
        product = symbols[place] = products[least]
        del symbols[place + 1], ranks[place]
        if place:
            ranks[place - 1] = rank((symbols[place - 1], product), none)
        if place < len(ranks):
            ranks[place] = rank((product, symbols[place + 1]), none)
    return symbols


def _merged_by_heap(symbols: list[int], vocabulary: Vocabulary) -> list[int]:
    """The same for many symbols: a heap of the pairs there are, and a list of who is next to whom."""
    rank, products = vocabulary.ranks, vocabulary.products
    kept: list[int | None] = list(symbols)
    after = [*range(1, len(kept)), None]
    before = [None, *range(len(kept) - 1)]
    heap = [(rank[p], place) for place, p in enumerate(zip(symbols, symbols[1:])) if p in rank]
    heapq.heapify(heap)
    while heap:
        least, place = heapq.heappop(heap)
        other = after[place]
        if other is None or rank.get((kept[place], kept[other])) != least:
            continue
        product = products[least]
        kept[place], kept[other] = product, None
        beyond = after[place] = after[other]
        if beyond is not None:
            before[beyond] = place
            if (pair := (product, kept[beyond])) in rank:
                heapq.heappush(heap, (rank[pair], place))
        if (left := before[place]) is not None and (pair := (kept[left], product)) in rank:
            heapq.heappush(heap, (rank[pair], left))
    return [symbol for symbol in kept if symbol is not None]


def _packed(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


class WordTransducer:
    """One word, fed as bytes. Tokens leave it as soon as nothing that may follow can change them."""

    def __init__(self, vocabulary: Vocabulary) -> None:
        self._vocabulary = vocabulary
        self._inside, self._last = vocabulary.inside, vocabulary.last
        self._lengths = [
            len(piece) - len(vocabulary.end) * piece.endswith(vocabulary.end)
            for piece in vocabulary.pieces
        ]
        self._lookahead = vocabulary.lookahead
        self.window = 4 * self._lookahead
        self._held = b""

    def feed(self, symbols: bytes) -> bytes:
        """The tokens that have become stable."""
        out: list[int] = []
        for start in range(0, len(symbols), self.window):
            self._held += symbols[start : start + self.window]
            if len(self._held) > self.window:
                out += self._stable()
        return _packed(out)

    def _stable(self) -> list[int]:
        # The last symbol may be the word's last one, which is another symbol.
        known = self._held[:-1]
        tokens = merged([self._inside[b] for b in known], self._vocabulary)
        settled = len(known) - self._lookahead
        place = count = 0
        while place + self._lengths[tokens[count]] <= settled:
            place += self._lengths[tokens[count]]
            count += 1
        self._held = self._held[place:]
        return tokens[:count]

    def finish(self) -> bytes:
        """The rest of the word's tokens; the next word may follow."""
        held, self._held = self._held, b""
        return self._rest(held)

    def _rest(self, held: bytes) -> bytes:
        if not held:
            return b""
        symbols = [self._inside[b] for b in held]
        symbols[-1] = self._last[held[-1]]
        return _packed(merged(symbols, self._vocabulary))

    def word(self, symbols: bytes) -> bytes:
        """The tokens of a whole word."""
        if len(symbols) <= self.window:
            return self._rest(symbols)
        return self.feed(symbols) + self.finish()


class _Known(dict):
    """The tokens of the words met so far."""

    def __init__(self, transducer: WordTransducer) -> None:
        super().__init__()
        self._transducer = transducer

    def __missing__(self, word: str) -> bytes:
        raw = word.encode()
        tokens = self._transducer.word(raw)
        if len(raw) <= WORD_BYTES:
            if len(self) >= MOST_WORDS:
                self.clear()
            self[word] = tokens
        return tokens


@lru_cache(maxsize=1)
def _second_characters() -> frozenset[str]:
    """Characters that may join the one before them when text is composed."""
    pairs = (unicodedata.decomposition(chr(c)).split() for c in range(0x110000))
    return frozenset(chr(int(p[1], 16)) for p in pairs if len(p) == 2 and p[0][0] != "<")


# Anything but Latin, Greek and Cyrillic letters, their marks and common punctuation, on which all
# versions of Unicode agree.
_rare = regex.compile(r"[^\u0000-\u052f\u2000-\u206f]").search


def _starts_anew(c: str) -> bool:
    """Whether composing a text cut before this character gives the same as composing it whole."""
    return c < "\x80" or (
        unicodedata.combining(c) == 0
        and unicodedata.category(c) != "Cn"
        and not "ᄀ" <= c <= "ᇿ"
        and unicodedata.is_normalized("NFC", c)
        and c not in _second_characters()
    )


def _character_class(characters: Iterable[int]) -> str:
    """An expression for any one of the characters; for none if there are none."""
    runs: list[list[int]] = []
    for c in sorted(characters):
        if runs and runs[-1][1] == c - 1:
            runs[-1][1] = c
        else:
            runs.append([c, c])
    listed = "".join(f"\\U{low:08x}-\\U{high:08x}" for low, high in runs)
    return f"[{listed}]" if listed else "(?!)"


class Encoder:
    """Texts to ids, portion by portion."""

    def __init__(self, vocabulary: Vocabulary, odd: dict[int, str]) -> None:
        self._normalize = vocabulary.tokenizer.normalizer.normalize_str
        self._special = vocabulary.special
        names = "|".join(regex.escape(s) for s in sorted(self._special, key=len, reverse=True))
        self._find_special = regex.compile(names).finditer if names else (lambda text: ())
        self._pattern = regex.compile(vocabulary.pattern)
        self._odd = odd
        self._has_odd = regex.compile(_character_class(odd)).search
        self._kinds = [regex.compile(kind) for kind in (r"\p{L}+", r"[^\s\p{L}\p{N}]+")]
        self._transducer = WordTransducer(vocabulary)
        self._known = _Known(WordTransducer(vocabulary))

    def encode(self, text: str) -> bytes:
        """All ids of a text, as little-endian unsigned 32-bit integers."""
        return b"".join(self.stream(text))

    def stream(self, text: str) -> Iterator[bytes]:
        """The ids of a text in parts, each as soon as it is stable."""
        start = 0
        for match in self._find_special(text):
            yield from self._plain(text, start, match.start())
            yield _packed([self._special[match.group()]])
            start = match.end()
        yield from self._plain(text, start, len(text))

    def _plain(self, text: str, start: int, end: int) -> Iterator[bytes]:
        rest, kind = "", None  # what is not settled yet; the kind of a word that is fed in parts
        while start < end:
            stop, whole = self._portion(text, start, end)
            part = text[start:stop]
            part = self._normalized(part)
            rest += part
            start = stop
            if kind is not None:
                run = kind.match(self._typical(rest))
                more = run.end() if run else 0
                yield self._transducer.feed(rest[:more].encode())
                rest = rest[more:]
                if not rest and not whole:
                    continue
                yield self._transducer.finish()
                kind = None
            if whole:
                yield self._words(rest)
                rest = ""
                continue
            settled, kind = self._settled(rest)
            yield self._words(rest[:settled])
            rest = rest[settled:]
            if kind is not None:
                yield self._transducer.feed(rest.encode())
                rest = ""

    def _normalized(self, text: str) -> str:
        if text.isascii():
            return text.lower()
        if unicodedata.is_normalized("NFC", text) and not _rare(text):
            # Python lower-cases only this letter by what is next to it.
            return text.replace("\u03a3", "\u03c3").lower()
        return self._normalize(text)

    def _portion(self, text: str, start: int, end: int) -> tuple[int, bool]:
        """Where the next portion ends, and whether no word reaches over that."""
        stop = start + PORTION
        if stop >= end:
            return end, True
        space = max(text.rfind(" ", start, stop), text.rfind("\n", start, stop))
        if space > start:
            return space, True
        while stop < end and not _starts_anew(text[stop]):
            stop += 1
        return stop, stop == end

    def _settled(self, rest: str) -> tuple[int, regex.Pattern | None]:
        """Up to where words are settled, and the kind of the word after that if it is fed in parts."""
        for match in self._pattern.finditer(self._typical(rest)):
            start, end = match.span()
            if end < len(rest) and len(rest) - start >= _CONTRACTED:
                continue
            if end == len(rest) and end - start >= OPEN:
                return start, next(kind for kind in self._kinds if kind.fullmatch(match.group()))
            return start, None
        return len(rest), None

    def _typical(self, text: str) -> str:
        """The text with odd characters replaced by common ones of their kind, for matching."""
        if text.isascii() or not _rare(text) or not self._has_odd(text):
            return text
        return text.translate(self._odd)

    def _words(self, text: str) -> bytes:
        known, typical = self._known, self._typical(text)
        if typical is text:
            return b"".join([known[word] for word in self._pattern.findall(text)])
        spans = (match.span() for match in self._pattern.finditer(typical))
        return b"".join([known[text[start:end]] for start, end in spans])


class Decoder:
    """Ids to text, portion by portion: pieces to bytes, and bytes to text."""

    def __init__(self, vocabulary: Vocabulary) -> None:
        self._shown = [piece.encode() for piece in vocabulary.pieces]
        own = {shown: bytes([b]) for b, shown in enumerate(visible_bytes())}
        end, special = vocabulary.end, set(vocabulary.special)
        self._plain = [
            piece.encode()
            if piece in special
            else b"".join(own[c] for c in piece.removesuffix(end)) + b" " * piece.endswith(end)
            for piece in vocabulary.pieces
        ]

    @staticmethod
    def _run(ids: np.ndarray, pieces: list[bytes], between: bytes) -> Iterator[str]:
        machine = codecs.getincrementaldecoder("utf-8")("replace")
        for start in range(0, len(ids), IDS):
            part = between.join([pieces[i] for i in ids[start : start + IDS].tolist()])
            yield machine.decode((between if start else b"") + part)
        yield machine.decode(b"", final=True)

    def decode(self, ids: bytes) -> Iterator[str]:
        """The visible pieces, separated by spaces."""
        return self._run(np.frombuffer(ids, dtype="<u4"), self._shown, b" ")

    def plain_text(self, ids: bytes) -> Iterator[str]:
        """Readable text; a word ends with a space."""
        return self._run(np.frombuffer(ids, dtype="<u4"), self._plain, b"")


# The machines of this worker, by the broadcast they came from; they last for all its tasks.
_machines: dict[str, tuple[Encoder, Decoder]] = {}


def encode(docs: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """Per row: doc_id, n_tokens, ids (little-endian unsigned 32 bit) and decoded, the ids as text."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast((vocabulary.config, odd_characters(vocabulary)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        config, odd = shared.value
        if config not in _machines:
            own = Vocabulary(config)
            _machines[config] = Encoder(own, odd), Decoder(own)
        encoder, decoder = _machines[config]
        for batch in batches:
            ids = [encoder.encode(text.as_py()) for text in batch.column("_text")]
            texts = ["".join(decoder.decode(x)) for x in ids]
            yield pa.record_batch(
                {
                    "_id": batch.column("_id"),
                    "ids": pa.array(ids, pa.binary()),
                    "decoded": pa.array(texts, pa.string()),
                }
            )

    texts = docs.select(
        F.coalesce(F.col("doc_id").cast("bigint"), F.lit(NULL_ID)).alias("_id"),
        F.coalesce(F.col("text"), F.lit("")).alias("_text"),
    )
    coded = texts.mapInArrow(run, "_id long, ids binary, decoded string")
    n_tokens = (F.octet_length("ids") / 4).cast("bigint")
    return coded.select(given_id(), n_tokens.alias("n_tokens"), "ids", "decoded")


def encoding_report(encoded: DataFrame) -> DataFrame:
    return encoded.select(
        "doc_id",
        "n_tokens",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
