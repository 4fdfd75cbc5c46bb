from __future__ import annotations

import random

import duckdb
import numpy as np
import pytest

from blotter.llm import fm_index, substring_dedup, tokens
from tests.conftest import SMALL
from tests.llm import brute
from tests.llm.conftest import ODD_ROWS, prose


def check(docs, rows):
    wanted = sorted(
        ((i, n, gone, brute.sha(kept)) for i, n, gone, kept in brute.cut_repeats([(r[0], r[1]) for r in rows])),
        key=repr,
    )
    got = [tuple(r) for r in substring_dedup.substring_report(docs).collect()]
    assert sorted(got, key=repr) == wanted
    return wanted


def test_equals_counting_all_windows(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    rows = duckdb.sql(f"SELECT doc_id, text FROM '{SMALL}/documents.parquet'").fetchall()
    assert sum(r[2] for r in check(docs, rows)) > 0


def passages():
    passage, edge = prose(60, 1).split(), prose(35, 2).split()
    rows = []
    for n in range(40):
        own = prose(50 + n, 100 + n).split()
        rows.append((n, " ".join(own[:20] + (passage if n % 3 else edge) + own[20:])))
    rows += [(50, " ".join(edge[:34])), (51, " ".join(passage[5:40]).upper()), (52, " ".join(passage[5:40]))]
    rows += [(60, "same " * 400), (61, "same " * 34), (62, "a b c " * 60), (63, prose(300, 7, 3))]
    rows += [(70, " ".join(["x", *edge, "y", *edge, "z"]))]
    return rows


@pytest.mark.parametrize("small", [False, True])
def test_passages(documents, monkeypatch, small):
    """Also with owners dealt out in parts and as single windows."""
    if small:
        monkeypatch.setattr(substring_dedup, "OWNER_WORDS", 50)
        monkeypatch.setattr(tokens, "SAMPLE", 1)
        monkeypatch.setattr(tokens, "PART", 2)
    rows = passages()
    check(documents(*rows), rows)


def test_odd_rows(documents):
    rows = [*ODD_ROWS, (30, prose(40000, 8)), (31, "w1 w2 " * 5000)]
    check(documents(*rows), rows)


def test_empty_table(documents):
    assert substring_dedup.substring_report(documents("a").limit(0)).collect() == []
    assert substring_dedup.substring_report(documents("a", None)).count() == 2


def test_documents_keep_their_columns(documents):
    text = prose(50, 3)
    docs = documents((1, text), (2, f"before {text} after"), (3, "as\n it  was"), (4, None))
    out = substring_dedup.remove_repeats(docs)
    assert out.schema.names == docs.schema.names
    rows = {r.doc_id: r for r in out.collect()}
    assert (rows[1].text, rows[2].text, rows[3].text, rows[4].text) == ("", "before after", "as\n it  was", None)
    assert rows[2].n_chars == 12


@pytest.mark.parametrize("seed", range(30))
def test_index_finds_repeated_windows(seed):
    rng = random.Random(seed)
    window = rng.choice([1, 2, 3, 5, 8])
    texts = [[rng.randrange(rng.choice([2, 4, 30])) for _ in range(rng.randint(0, 25))] for _ in range(rng.randint(1, 12))]
    times = [rng.choice([1, 1, 2]) for _ in texts]
    index = fm_index.FmIndex([np.array(t, dtype=np.int64) for t in texts], np.array(times), window)
    counts = {}
    for text, n in zip(texts, times):
        for i in range(len(text) - window + 1):
            key = tuple(text[i : i + window])
            counts[key] = counts.get(key, 0) + n
    for text, found in zip(texts, index.repeated()):
        assert found.tolist() == [
            i for i in range(len(text) - window + 1) if counts[tuple(text[i : i + window])] > 1
        ]


def test_wavelet_ranks():
    rng = np.random.default_rng(1)
    symbols = rng.integers(0, 37, 1000)
    matrix = fm_index.WaveletMatrix(symbols, 37)
    places, asked = rng.integers(0, 1001, 300), rng.integers(0, 37, 300)
    wanted = [(symbols[:p] == c).sum() for p, c in zip(places, asked)]
    assert matrix.rank(asked, places).tolist() == wanted


@pytest.mark.parametrize("span", [1, 2, 3, 31, 32])
def test_smallest_of_neighbours(span):
    values = np.random.default_rng(span).integers(0, 50, 200).astype(np.uint64)
    wanted = [values[at : at + span].min() for at in range(len(values) - span + 1)]
    assert substring_dedup.smallest(values, span).tolist() == wanted


def test_frequent_tokens_are_told_by_their_first_bits():
    """Tokens that share their first bits with a frequent one, and such that don't."""
    known = np.sort(np.random.default_rng(4).integers(0, 2**63, 300).astype(np.uint64) * np.uint64(2))
    frequent = tokens.Frequent(known, np.arange(1, 301))
    asked = np.concatenate([known[::3], known[::3] + np.uint64(1), np.array([0, 2**64 - 1], np.uint64)])
    times = dict(zip(known.tolist(), range(1, 301)))
    assert frequent.seen(asked).tolist() == [times.get(t, 0) for t in asked.tolist()]
    assert int(frequent.begins.sum()) <= 300


@pytest.mark.parametrize("seed", range(10))
def test_suffix_ranks_with_numbers_left_out(seed):
    """Word numbers need not be dense; ranks are those of the sorted suffixes."""
    rng = np.random.default_rng(seed)
    text = rng.choice([0, 3, 50], 80)
    rank, by_power = fm_index.suffix_ranks(text, 5)
    suffixes = [tuple(text[at:].tolist()) for at in range(len(text))]
    order = sorted(suffixes)
    assert rank.tolist() == [order.index(s) for s in suffixes]
    heads = sorted(s[:4] for s in suffixes)
    assert by_power.tolist() == [heads.index(s[:4]) for s in suffixes]
