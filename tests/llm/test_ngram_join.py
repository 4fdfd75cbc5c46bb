from __future__ import annotations

import duckdb
import numpy as np
import pytest

from blotter.llm import components, ngram_join, tokens
from tests.conftest import SMALL
from tests.llm import brute
from tests.llm.conftest import ODD_ROWS, prose


def check(docs, rows):
    wanted = brute.classes([(r[0], r[1]) for r in rows])
    got = ngram_join.class_report(docs).collect()
    assert len(got) == len(rows)
    by_text = {(r[0], len(brute.shingles(r[1]))) for r in rows}
    assert {(r.doc_id, r.n_shingles) for r in got} == by_text
    for r in got:
        assert brute.least_id(r.component_id) == wanted[brute.least_id(r.doc_id)]
    return got


def test_equals_all_pairs(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    rows = duckdb.sql(f"SELECT doc_id, text FROM '{SMALL}/documents.parquet'").fetchall()
    check(docs, rows)


def family(seed):
    base = prose(90, seed).split()
    texts = [" ".join(base)] + [t for e in (1, 2, 3) for t in brute.near_copies(base, 7, e, seed + e)]
    return [" ".join([prose(14, 99), t]) for t in texts]


@pytest.mark.parametrize("small", [False, True])
def test_families_of_near_copies(documents, monkeypatch, small):
    """Also with meetings split into chunks and lists in parts."""
    if small:
        monkeypatch.setattr(ngram_join, "MEETING", 3)
        monkeypatch.setattr(tokens, "SAMPLE", 1)
        monkeypatch.setattr(tokens, "PART", 2)
    rows = list(enumerate([t for seed in (10, 20, 30) for t in family(seed)]))
    rows += [(1000 + i, t) for i, t in rows[::5]]
    got = check(documents(*rows), rows)
    assert len({r.component_id for r in got}) < 60


def test_sizes_at_the_limit(documents):
    words = [f"w{i}" for i in range(104)]  # 100 shingles
    rows = [(0, " ".join(words)), (1, " ".join(words[:79])), (2, " ".join(words[:78]))]
    rows += [(3, " ".join(words[40:44])), (4, " ".join(words[40:44]).upper()), (5, "w40")]
    got = {r.doc_id: r.component_id for r in check(documents(*rows), rows)}
    assert got[1] == 0 and got[4] == 3


@pytest.mark.parametrize("short, long", [(6, 8), (12, 15), (12, 16)])
def test_a_copy_with_text_added(documents, short, long):
    """Shingles that only one of the two has first may be anywhere in the other."""
    texts = [prose(long + 4, 1000 + seed).split() for seed in range(80)]
    rows = [(2 * n, " ".join(words[: short + 4])) for n, words in enumerate(texts)]
    rows += [(2 * n + 1, " ".join(words)) for n, words in enumerate(texts)]
    got = {r.doc_id: r.component_id for r in check(documents(*rows), rows)}
    assert all(got[i] == i - i % 2 for i in got)


def test_a_frequent_passage_with_a_rare_addition(documents, monkeypatch):
    """The added shingles are rarer than the common ones, and so come first."""
    monkeypatch.setattr(tokens, "SAMPLE", 1)
    passages = [prose(34, 50 + n) for n in range(4)]
    rows = [(100 * n + k, f"{text} {prose(k, 900 + 10 * n + k)}") for n, text in enumerate(passages) for k in range(9)]
    got = {r.doc_id: r.component_id for r in check(documents(*rows), rows)}
    assert all(got[100 * n + 8] == 100 * n for n in range(4))


def test_odd_rows(documents):
    rows = [*ODD_ROWS, (30, "x " * 30000), (31, prose(30000, 8)), (32, prose(30000, 8) + " end")]
    check(documents(*rows), rows)


def test_empty_table(documents):
    assert ngram_join.class_report(documents("a").limit(0)).collect() == []
    assert ngram_join.class_report(documents(None, "", " ")).count() == 3


def test_one_of_each_class_stays(documents):
    text = prose(100, 5)
    docs = documents((4, text), (2, text.upper()), (9, prose(100, 6)), (7, None))
    out = ngram_join.keep_one(docs)
    assert out.schema.names == docs.schema.names
    assert sorted(r.doc_id for r in out.collect()) == [2, 7, 9]


def test_similarity_of_sets_is_exact():
    a = np.arange(100, dtype=np.uint64)
    sets = [a, a[:75], a[:74], a[50:], a + np.uint64(1000)]
    wanted = [[100 * len({*x} & {*y}) >= 75 * len({*x} | {*y}) for y in sets] for x in sets]
    assert ngram_join.similar(sets).tolist() == wanted


@pytest.mark.parametrize("edges", [
    [], [(1, 1)], [(n, n + 1) for n in range(60)], [(100, n) for n in range(90)] + [(200, 100), (300, 301)],
    [(7 * n % 101, 13 * n % 101) for n in range(40)],
])
def test_components(spark, edges):
    parent = {x: x for e in edges for x in e}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        x, y = sorted((find(a), find(b)))
        parent[y] = x
    wanted = sorted((x, find(x)) for x in parent if find(x) != x)
    frame = spark.createDataFrame(edges, "u long, v long")
    assert sorted((r.u, r.v) for r in components.components(frame).collect()) == wanted


def test_sketches_bound_what_sets_share():
    """A similar pair is never ruled out, also where short hashes collide very often."""
    rng = np.random.default_rng(6)
    for size in (3, 40, 1000, 60_000):
        base = rng.integers(0, 2**63, size).astype(np.uint64)
        base = np.unique(base)
        sets = [base]
        for changed in (0.0, 0.05, 0.12, 0.14, 0.2, 0.5):
            keep = base[rng.random(len(base)) >= changed]
            new = rng.integers(0, 2**63, int(changed * len(base))).astype(np.uint64)
            sets.append(np.unique(np.concatenate([keep, new])))
        truly = ngram_join.similar(sets)
        maybe = ngram_join.maybe_similar([ngram_join.sketch(s) for s in sets], np.array([len(s) for s in sets]))
        assert not (truly & ~maybe).any()
        if 40 <= size <= 1000:
            assert not maybe[0, -1]
