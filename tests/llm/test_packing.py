from __future__ import annotations

import random
import struct
import zlib
from collections import Counter, defaultdict

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from blotter.llm import packing
from tests.llm.conftest import ODD_ROWS, prose

RANKS, PATTERN = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
SPECIAL = packing.special_tokens(public_tokenizers.path("byte_bpe_50k.json"))


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def check(rows, report, tokenizer, capacity):
    """Whole pieces in order, gapless sequences, and the tokenizer's own ids."""
    wanted = Counter()
    for doc_id, text in rows:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, packing.END]
        cuts = packing.cut_points(len(ids), capacity)
        assert all(b - a <= capacity for a, b in zip(cuts, cuts[1:]))
        for piece, (a, b) in enumerate(zip(cuts, cuts[1:])):
            crc = zlib.crc32(struct.pack(f"<{b - a}I", *ids[a:b]))
            wanted[doc_id, piece, a, b - a, crc] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in report) == wanted
    sequences = defaultdict(list)
    for r in report:
        sequences[r.sequence_id].append((r.offset, r.length))
    for parts in sequences.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= capacity
    return len(sequences)


@pytest.mark.parametrize("capacity", [1024, 32])
def test_odd_and_long_rows(documents, tokenizer, capacity):
    rows = [*((r[0], r[1]) for r in ODD_ROWS), (20, prose(5000, 9)), (21, "x" * 4000), (22, "<|endoftext|>"), (23, "a <|endoftext|>b")]
    packed = packing.pack(documents(*rows), RANKS, PATTERN, capacity, special=SPECIAL)
    report = packing.packing_report(packed).collect()
    check(rows, report, tokenizer, capacity)
    whole = packed.sequences().collect()
    assert all(len(r.ids) == 4 * r.length and len(r.doc_ids) == len(r.offsets) for r in whole)
    assert sum(r.length for r in whole) == sum(r.length for r in report)


def test_empty_table(documents):
    packed = packing.pack(documents("a").limit(0), RANKS, PATTERN)
    assert packing.packing_report(packed).collect() == [] and packed.sequences().collect() == []


def decreasing(lengths, capacity):
    """Best-fit decreasing, one piece at a time."""
    gaps = []
    for length in sorted(lengths, reverse=True):
        fitting = [g for g in gaps if g >= length]
        if fitting:
            gaps.remove(min(fitting))
            gaps.append(min(fitting) - length)
        else:
            gaps.append(capacity - length)
    return len(gaps)


@pytest.mark.parametrize("seed", range(20))
def test_supersteps_are_best_fit_decreasing(seed):
    rng = random.Random(seed)
    capacity = rng.choice([7, 64, 1024])
    lengths = [rng.randint(1, rng.choice([capacity, max(1, capacity // 9)])) for _ in range(rng.randint(1, 400))]
    plan = packing.best_fit(Counter(lengths), capacity)
    filled = defaultdict(list)
    runs = list(zip(plan.key.tolist(), plan.first.tolist(), plan.offset.tolist()))
    for length, n in Counter(lengths).items():
        for rank in range(n):
            key, first, offset = max(r for r in runs if r[0] <= (length << 40 | rank))
            filled[first + (length << 40 | rank) - key].append((offset, length))
    for parts in filled.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= capacity
    assert len(filled) == decreasing(lengths, capacity)
