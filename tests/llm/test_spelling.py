from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from blotter.llm import spelling
from tests.conftest import SMALL
from tests.llm.brute import lower
from tests.llm.conftest import ODD_ROWS


def words(rows) -> Counter:
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = lower(run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 31 == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
            if len(run) >= 7:
                counts[run] += 1
    return Counter({word: n for word, n in counts.items() if n >= 2})


def is_near(a: str, b: str) -> bool:
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(a) + 1 == len(b) and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def variants(counts: Counter) -> set:
    near = {w: [o for o in counts if is_near(w, o)] for w in counts}
    form = {}
    for word, others in near.items():
        best = min(others, key=lambda o: (-counts[o], o), default=None)
        form[word] = best if best is not None and counts[best] >= 10 * counts[word] else None
    out = set()
    for word, n in counts.items():
        root = word
        while form[root] is not None:
            root = form[root]
        out.add((word, form[word], root, n, len(near[word]), counts.get(form[word])))
    return out


def check(docs) -> set:
    rows = [(r.doc_id, r.text) for r in docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").collect()]
    found = spelling.variants(docs)
    assert found.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    got = [tuple(r) for r in found.collect()]
    assert len(set(got)) == len(got)
    assert set(got) == variants(words(rows))
    return set(got)


def test_equals_brute_force(spark):
    # The table's words of at least two occurrences are too many to compare all with all in the test.
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").where("doc_id < 60")
    assert len(check(docs)) > 100


def family(base: str, n: int, seed: int) -> list[str]:
    rng = random.Random(seed)
    letters = "abcdefghijklmnopqrstuvwxyzéü×"
    out = [base]
    while len(out) < n:
        word = rng.choice(out)
        at = rng.randrange(len(word) + 1)
        kind = rng.randrange(3)
        changed = word[:at] + rng.choice(letters) * (kind < 2) + word[at + (kind > 0) :]
        if len(changed) >= 7:
            out.append(changed)
    return out


@pytest.mark.parametrize("chunk", [4096, 3])
def test_families_with_shards_of_any_size(documents, monkeypatch, chunk):
    monkeypatch.setattr(spelling, "CHUNK", chunk)
    rows = [" ".join(family(base, 60, seed) * 2) for seed, base in enumerate(["remember", "aaaaaaaa", "straßenbahn"])]
    rows += ["remember " * 300, "rememberr " * 25, "rememberrr rememberrr", "AAAAAAAA aaaaaaaaa " * 40]
    found = check(documents(*rows))
    by_word = {r[0]: r for r in found}
    assert by_word["rememberrr"][1:3] == ("rememberr", "remember")


def test_ties_go_to_the_smallest_word(documents):
    text = " ".join(["testing"] * 2 + ["testink"] * 40 + ["testina"] * 40 + ["testéng"] * 40)
    found = {r[0]: r for r in check(documents(text))}
    assert found["testing"][1] == "testina"


def test_index_equals_the_definition():
    rng = random.Random(5)
    vocabulary = sorted({"".join(rng.choice("ab") for _ in range(rng.choice((7, 8)))) for _ in range(150)})
    index = spelling.Index(vocabulary)
    for word in vocabulary:
        near = {vocabulary[v] for v in spelling._places(index.near(word, 7))}
        assert near == {o for o in vocabulary if is_near(word, o) and min(len(word), len(o)) == 7}


def test_odd_rows(documents):
    rows = [*ODD_ROWS, (None, "weiterer weiterer 中文weiterer"), (20, "x" * 50_000 + " " + "x" * 50_000)]
    check(documents(*rows))
    assert check(documents(*rows).limit(0)) == set()


def test_damaged_words_are_counted_by_their_rest(monkeypatch):
    monkeypatch.setattr(spelling, "DAMAGED", 1)
    found = list(spelling.words_of(3, "abcdefg abcdefgh Àbcdefgh"))
    for run in ("abcdefgh", "Àbcdefgh"):
        at = zlib.crc32(f"3:{run}".encode()) % 8
        assert (run[:at] + run[at + 1 :]).encode("latin-1") in found
    assert len(found) == 2
