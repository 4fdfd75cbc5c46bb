"""A compressed full-text index over word numbers: Burrows-Wheeler transform and wavelet matrix.

The texts of a shard, each closed by a separator of its own, are sorted by suffix; the transform
is kept as bits, one level per bit of a word number, with counts for rank queries. Backward
search goes from a text's separator to its first word, one rank query a word, for all texts of the
shard side by side. A bit vector marks where suffixes stop sharing `window` words, so that the
matching statistic at a word reaches the window length exactly if its mark's block holds more.
"""

from __future__ import annotations

import numpy as np


class BitVector:
    """Packed bits with the number of ones before any place."""

    def __init__(self, bits: np.ndarray) -> None:
        packed = np.packbits(bits, bitorder="little")
        whole = np.zeros(len(bits) // 64 + 1, dtype="<u8")
        whole.view(np.uint8)[: len(packed)] = packed
        self.words = whole
        self.before = np.zeros(len(whole), dtype=np.int64)
        self.before[1:] = np.cumsum(np.bitwise_count(whole), dtype=np.int64)[:-1]

    def ones(self, place: np.ndarray) -> np.ndarray:
        """How many ones lie before each place."""
        word = place >> 6
        below = (np.uint64(1) << (place & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[word] + np.bitwise_count(self.words[word] & below)


class WaveletMatrix:
    """Symbols as one bit vector per bit, the highest first, zeros sorted before ones."""

    def __init__(self, symbols: np.ndarray, alphabet: int) -> None:
        self.shifts = range(max(1, int(alphabet - 1).bit_length()) - 1, -1, -1)
        self.levels: list[tuple[BitVector, int]] = []
        current = symbols
        for shift in self.shifts:
            ones = ((current >> shift) & 1).astype(bool)
            self.levels.append((BitVector(ones), int(len(ones) - ones.sum())))
            current = np.concatenate([current[~ones], current[ones]])
        every = np.arange(alphabet)
        self.first = self._descend(every, np.zeros(alphabet, dtype=np.int64))

    def _descend(self, symbols: np.ndarray, place: np.ndarray) -> np.ndarray:
        for shift, (bits, zeros) in zip(self.shifts, self.levels):
            ones = bits.ones(place)
            place = np.where((symbols >> shift) & 1, zeros + ones, place - ones)
        return place

    def rank(self, symbols: np.ndarray, place: np.ndarray) -> np.ndarray:
        """How often each symbol stands before its place."""
        return self._descend(symbols, place) - self.first[symbols]


def suffix_ranks(text: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """The rank of every suffix, and its rank by as many words as a power of two below `window` has.

    A rank is the number of smaller suffixes, so each round sorts only those that still share theirs.
    """
    n = len(text)
    counts = np.bincount(text)
    rank = (np.cumsum(counts) - counts)[text]
    shared = np.flatnonzero(counts[text] > 1)
    length, at_window = 1, rank
    while True:
        if length <= window:
            at_window = rank.copy()
        if not len(shared):
            return rank, at_window
        later = np.zeros(len(shared), dtype=np.int64)
        inside = np.flatnonzero(shared < n - length)
        later[inside] = rank[shared[inside] + length] + 1
        pair = rank[shared] * (n + 1) + later
        order = np.argsort(pair)
        shared, pair = shared[order], pair[order]
        head = rank[shared]
        place = np.arange(len(shared))
        opens = np.append(True, pair[1:] != pair[:-1])
        first = np.maximum.accumulate(np.where(opens, place, 0))
        group = np.maximum.accumulate(np.where(np.append(True, head[1:] != head[:-1]), place, 0))
        rank[shared] = head + first - group
        shared = shared[~(opens & np.append(opens[1:], True))]
        length *= 2


class FmIndex:
    """An index of texts (arrays of word numbers from 0 on), each standing for `times` occurrences."""

    def __init__(self, texts: list[np.ndarray], times: np.ndarray, window: int) -> None:
        self.window = window
        self.lengths = np.array([len(t) for t in texts], dtype=np.int64)
        n_texts = len(texts)
        self.starts = np.cumsum(self.lengths + 1) - self.lengths - 1
        words = np.concatenate(texts) if n_texts else np.empty(0, np.int64)
        alphabet = int(words.max(initial=-1)) + 1
        # Separators are the smallest symbols, ascending; in the transform they all count as 0.
        self.text = np.empty(len(words) + n_texts, dtype=np.int64)
        is_word = np.ones(len(self.text), dtype=bool)
        is_word[self.starts + self.lengths] = False
        self.text[is_word] = words + n_texts
        self.text[~is_word] = np.arange(n_texts)
        rank, by_power = suffix_ranks(self.text, window)
        order = np.empty(len(rank), dtype=np.int64)
        order[rank] = np.arange(len(rank))
        symbols = np.where(is_word, self.text - n_texts + 1, 0)
        self.symbols = symbols
        self.transform = WaveletMatrix(symbols[order - 1], alphabet + 1)
        counts = np.bincount(symbols, minlength=alphabet + 1)
        self.before = np.cumsum(counts) - counts
        # Two neighbouring suffixes share the window if they do so from its start and to its end.
        power = 1 << (window.bit_length() - 1)
        late = np.minimum(np.arange(len(rank)) + window - power, len(rank) - 1)
        key = np.column_stack([by_power, by_power[late]])[order]
        opens = np.ones(len(rank), dtype=bool)
        opens[1:] = (key[1:] != key[:-1]).any(axis=1)
        self.blocks = BitVector(opens)
        owner = np.repeat(np.arange(n_texts), self.lengths + 1)
        self.weights = np.bincount(np.cumsum(opens) - 1, weights=times[owner][order]).astype(np.int64)

    def step(self, symbols: np.ndarray, rows: np.ndarray) -> np.ndarray:
        """Backward search: the rows of the suffixes that begin one word earlier."""
        return self.before[symbols] + self.transform.rank(symbols, rows)

    def repeated(self) -> list[np.ndarray]:
        """Per text, where windows begin whose words begin elsewhere too."""
        found = np.zeros(len(self.text), dtype=bool)
        by_length = np.argsort(-self.lengths, kind="stable")
        lengths, starts = self.lengths[by_length], self.starts[by_length]
        rows = by_length.copy()  # the suffix of a separator alone
        longest = int(lengths[0]) if len(lengths) else 0
        for done in range(longest):
            active = int(np.searchsorted(-lengths, -done, side="left"))
            place = starts[:active] + lengths[:active] - 1 - done
            rows = self.step(self.symbols[place], rows[:active])
            if done + 1 >= self.window:
                block = self.blocks.ones(rows + 1) - 1
                found[place] = self.weights[block] > 1
        return [
            np.flatnonzero(found[start : start + length])
            for start, length in zip(self.starts, self.lengths)
        ]
