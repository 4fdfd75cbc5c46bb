from __future__ import annotations

import hashlib
import random

import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

import __spark_entry__ as contract
from blotter.llm import word_bpe
from tests.conftest import SMALL
from tests.llm.conftest import ODD_ROWS

PATH = public_tokenizers.path("word_bpe_49k.json")
VOCABULARY = word_bpe.read_vocabulary(PATH)
LIBRARY = Tokenizer.from_file(PATH)
ENCODER = word_bpe.Encoder(VOCABULARY, word_bpe.odd_characters(VOCABULARY))
DECODER = word_bpe.Decoder(VOCABULARY)


def theirs(text: str) -> list[int]:
    return LIBRARY.encode(text, add_special_tokens=False).ids


def ours(text: str) -> list[int]:
    raw = ENCODER.encode(text)
    return [int.from_bytes(raw[at : at + 4], "little") for at in range(0, len(raw), 4)]


def check(text: str) -> None:
    ids = theirs(text)
    assert ours(text) == ids
    raw = ENCODER.encode(text)
    assert "".join(DECODER.decode(raw)) == LIBRARY.decode(ids, skip_special_tokens=False)


@pytest.mark.parametrize(
    "text",
    [
        "", " \t\n", "Hello World's don't I'LL 'llama ''s 'Re", "a<|startoftext|>B <|endoftext|>'s",
        "ΑΣ ΣΑΣ İstanbul é é 각 日本語 \U0001f600 १२३ x\x1cy\x85z\xa0w", "ཱིུ ẍ́",
        "՘ a՘!՘ \U0001246f1\U000323b0",
    ],
)
def test_equals_the_library(text):
    check(text)


@settings(max_examples=150, deadline=None)
@given(st.text(st.characters(exclude_categories=["Cs"]), max_size=60))
def test_any_text(text):
    check(text)


@settings(max_examples=150, deadline=None)
@given(st.text("abthe'slr !1é́Σ\n", max_size=80))
def test_usual_text(text):
    check(text)


def test_every_character():
    check("x".join(chr(c) for c in range(0x3400) if not 0xD800 <= c < 0xE000))
    check(" ".join(chr(c) for c in range(0x10000, 0x20000)))


@pytest.mark.parametrize("alphabet", ["a", "ab", "abcdefghijklmnopqrstuvwxyz", "théx", "!'", "'sl!", "日本é", "a1'", "é"])
def test_words_longer_than_portions(alphabet):
    rng = random.Random(alphabet)
    for length in (word_bpe.PORTION - 1, word_bpe.PORTION, 2 * word_bpe.PORTION + 77):
        check("".join(rng.choice(alphabet) for _ in range(length)))


def test_a_long_word_takes_linear_time_and_constant_state():
    transducer = word_bpe.WordTransducer(VOCABULARY)
    rng = random.Random(3)
    word = "".join(rng.choice("etaoinshr") for _ in range(200_000))
    out, most = [], 0
    for at in range(0, len(word), 1000):
        out.append(transducer.feed(word[at : at + 1000].encode()))
        most = max(most, len(transducer._held))
    out.append(transducer.finish())
    assert most <= 2 * transducer.window
    assert b"".join(out) == ENCODER.encode(word)


def test_emitted_tokens_are_stable():
    rng = random.Random(4)
    for _ in range(40):
        start = "".join(rng.choice("theaning") for _ in range(700))
        told = set()
        for _ in range(3):
            transducer = word_bpe.WordTransducer(VOCABULARY)
            told.add(transducer.feed(start.encode()))
            end = "".join(rng.choice("theaning") for _ in range(rng.randrange(1, 60)))
            rest = transducer.feed(end.encode()) + transducer.finish()
            whole = word_bpe.WordTransducer(VOCABULARY).word((start + end).encode())
            assert whole == told.copy().pop() + rest
        assert len(told) == 1 and told.pop()


def test_lookahead_of_small_lists():
    length = len
    assert word_bpe.lookahead([], length) == 1
    assert word_bpe.lookahead([("a", "b")], length) == 2
    # What follows c decides on bc, and that on ab.
    assert word_bpe.lookahead([("c", "d"), ("b", "c"), ("a", "b")], length) == 4
    assert word_bpe.lookahead([("a", "b"), ("b", "c"), ("c", "d")], length) == 2
    with pytest.raises(word_bpe.ImproperMerges):
        word_bpe.lookahead([("ab", "c"), ("a", "b")], length)
    with pytest.raises(word_bpe.ImproperMerges):
        word_bpe.lookahead([("a", "b"), ("b", "c"), ("ab", "c"), ("a", "bc")], length)


def test_plain_text_over_portions(monkeypatch):
    monkeypatch.setattr(word_bpe, "IDS", 3)
    text = "straße 日本語 \U0001f600 end"
    assert "".join(DECODER.plain_text(ENCODER.encode(text))) == text + " "
    assert "".join(DECODER.decode(ENCODER.encode(text))) == LIBRARY.decode(theirs(text), skip_special_tokens=False)
    broken = word_bpe._packed([VOCABULARY.inside[0xE6], VOCABULARY.last[0x97]])
    assert "".join(DECODER.plain_text(broken)) == "� "


def test_known_words_are_forgotten(monkeypatch):
    monkeypatch.setattr(word_bpe, "MOST_WORDS", 5)
    encoder = word_bpe.Encoder(VOCABULARY, {})
    text = "one two three four five six seven one two three"
    assert encoder.encode(text) == ENCODER.encode(text)
    assert len(encoder._known) <= 5


def test_rows(spark, documents):
    rows = [*ODD_ROWS, (9, "x" * 70_000), (9, "<|endoftext|> again")]
    found = word_bpe.encoding_report(word_bpe.encode(documents(*rows), VOCABULARY)).collect()
    want = []
    for row in rows:
        ids = theirs(row[1] or "")
        packed = b"".join(i.to_bytes(4, "little") for i in ids)
        decoded = LIBRARY.decode(ids, skip_special_tokens=False)
        want.append((row[0], len(ids), hashlib.sha256(packed).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest()))
    assert sorted(map(tuple, found), key=repr) == sorted(want, key=repr)
    assert word_bpe.encode(documents(*rows).limit(0), VOCABULARY).count() == 0


def test_query(spark):
    found = {row.doc_id: row for row in contract.queries()["op13_word_bpe"](spark, SMALL).collect()}
    for row in spark.read.parquet(f"{SMALL}/documents.parquet").collect():
        ids = theirs(row.text or "")
        packed = b"".join(i.to_bytes(4, "little") for i in ids)
        assert found[row.doc_id].n_tokens == len(ids)
        assert found[row.doc_id].ids_sha256 == hashlib.sha256(packed).hexdigest()
