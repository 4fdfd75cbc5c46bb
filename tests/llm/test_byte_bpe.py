from __future__ import annotations

import random
import struct
import time
from collections import Counter

import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from blotter.llm import byte_bpe
from tests.llm.conftest import ODD_ROWS, prose

RANKS = byte_bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
PATTERN = public_tokenizers.PATTERN


@pytest.fixture(scope="module")
def library():
    return tiktoken.Encoding("t", pat_str=PATTERN, mergeable_ranks=RANKS, special_tokens={})


def random_texts(n):
    rng = random.Random(11)
    kinds = ["abcdeé ", " \t\n\x0b\x0c\r\x1c\x85  　", "0123٣½², ", "日本語テキスト。", "\U0001f600‍♂️\U0001f1e9", "'s't're've'm'll'd ", "#*$%&|<>!? "]
    return ["".join(rng.choice(rng.choice(kinds)) for _ in range(rng.randrange(120))) for _ in range(n)]


def test_equals_the_library(documents, library):
    rows = [*((r[0], r[1]) for r in ODD_ROWS), *((100 + n, t) for n, t in enumerate(random_texts(150)))]
    rows += [(50, "a" * 2000), (51, prose(20000, 3)), (52, "<|endoftext|>"), (53, "aé" * 300)]
    wanted = Counter()
    for doc_id, text in rows:
        ids = library.encode_ordinary(text or "")
        wanted[doc_id, len(ids), struct.pack(f"<{len(ids)}I", *ids), (text or "").encode()] += 1
    got = byte_bpe.encode(documents(*rows).repartition(3), RANKS, PATTERN).collect()
    assert Counter((r.doc_id, r.n_tokens, bytes(r.ids), bytes(r.decoded)) for r in got) == wanted


def test_blocks_and_forgotten_words(documents, library, monkeypatch):
    """Several blocks a task, with words met before and words forgotten."""
    monkeypatch.setattr(byte_bpe, "BLOCK_BYTES", 300)
    monkeypatch.setattr(byte_bpe, "MOST_WORDS", 100)
    rows = [(n, prose(60, n % 7)) for n in range(40)]
    for r in byte_bpe.encode(documents(*rows).coalesce(1), RANKS, PATTERN).collect():
        ids = library.encode_ordinary(rows[r.doc_id][1])
        assert bytes(r.ids) == struct.pack(f"<{len(ids)}I", *ids)


def test_empty_table(documents):
    assert byte_bpe.encode(documents("a").limit(0), RANKS, PATTERN).collect() == []


def test_ties_go_to_the_left(spark):
    """The same pair twice, overlapping: the left one merges first."""
    ranks = {bytes([b]): b for b in range(256)} | {b"aa": 256, b"ab": 257, b"aab": 258}
    library = tiktoken.Encoding("t", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    words = ["aaa", "aaaa", "aaab", "aab", "baab", "b", "aaaaaaaab"]
    table = spark.createDataFrame([(w,) for w in words], "w string").withColumn("w", F.col("w").cast("binary"))
    coded = byte_bpe._let(byte_bpe.rank_literal(ranks), lambda t: byte_bpe.encode_word(t, F.col("w")))
    for row in table.select("w", coded.alias("ids")).collect():
        assert row.ids == library.encode_ordinary(bytes(row.w).decode())


def test_the_fold_equals_the_library_on_any_bytes(spark, library):
    """Also for words of one byte and two, of up to LONG_WORD, and in which nothing merges."""
    rng = random.Random(12)
    words = [bytes([b]) for b in range(256)] + [b"ab", b"\xff\xfe\x00", b"a" * byte_bpe.LONG_WORD]
    words += [rng.randbytes(n) for n in range(2, 40)]
    words += ["".join(rng.choice("etaoinshrdluéü") for _ in range(n)).encode() for n in range(2, 130)]
    table = spark.createDataFrame([(w,) for w in words], "w binary")
    coded = byte_bpe._let(byte_bpe.rank_literal(RANKS), lambda t: byte_bpe.encode_word(t, F.col("w")))
    for row in table.select("w", coded.alias("ids")).collect():
        assert row.ids == library._encode_single_piece(bytes(row.w))


def test_a_merge_only_drops_a_cut(spark):
    """The fold holds the cuts of a word, not its pieces and their ranks, whose slices took most of the time."""
    ranks = {bytes([b]): b for b in range(256)}
    word = spark.createDataFrame([(bytearray(b"abc"),)], "w binary")
    coded = byte_bpe._let(byte_bpe.rank_literal(ranks), lambda t: byte_bpe.encode_word(t, F.col("w")))
    plan = word.select(coded.alias("ids"))._jdf.queryExecution().analyzed().toString()
    assert "array_remove" in plan and "slice(" not in plan and "array_position" not in plan


def test_decoding_is_native(spark):
    ids = spark.createDataFrame([([72, 101, 108],), ([],)], "ids array<int>")
    ranks = {bytes([b]): b for b in range(256)}
    out = ids.select(byte_bpe.decode(F.col("ids"), byte_bpe.piece_literal(ranks)).alias("d"))
    assert [bytes(r.d) for r in out.collect()] == [b"Hel", b""]
    assert "Python" not in out._jdf.queryExecution().toString()


@pytest.mark.parametrize("alphabet", ["a", "ab", "etaoinshrdlu", "日本語é"])
def test_long_words(library, alphabet):
    rng = random.Random(alphabet)
    for length in (1, 2, 257, 5000):
        word = "".join(rng.choice(alphabet) for _ in range(length)).encode()
        assert byte_bpe.encode_long(RANKS, word) == library._encode_single_piece(word)


def test_a_very_long_word_takes_seconds(library):
    rng = random.Random(9)
    word = "".join(rng.choice("etaoinshrdlu") for _ in range(200_000)).encode()
    started = time.perf_counter()
    ids = byte_bpe.encode_long(RANKS, word)
    assert time.perf_counter() - started < 10
    tokens = {rank: token for token, rank in RANKS.items()}
    assert b"".join(tokens[i] for i in ids) == word


def test_long_and_short_words_together(documents, library):
    rng = random.Random(10)
    texts = [
        " ".join("".join(rng.choice("etaoin") for _ in range(n)) for n in (3, 255, 256, 257, 3000, 3))
        for _ in range(4)
    ]
    found = byte_bpe.encode(documents(*enumerate(texts)), RANKS, PATTERN).collect()
    assert len(found) == 4
    for r in found:
        ids = library.encode_ordinary(texts[r.doc_id])
        assert bytes(r.ids) == struct.pack(f"<{len(ids)}I", *ids) and bytes(r.decoded).decode() == texts[r.doc_id]
