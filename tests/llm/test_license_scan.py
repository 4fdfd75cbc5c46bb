from __future__ import annotations

import math
import random
import textwrap
from collections import Counter

import pytest

from blotter.llm import license_scan
from tests.llm.conftest import prose

APACHE = "Licensed under the Apache License, Version 2.0."
MIT = "Released under the MIT License."
GPL = license_scan.TEMPLATES["GPL-3.0"][1]


def scan(spark, rows):
    frame = spark.createDataFrame([(*r, -1, "x") for r in rows], "path string, text string, depth int, licence string")
    return {r.path: r for r in license_scan.licences(frame).collect()}


def background(n=40):
    return [(f"other/p{i}", prose(60, i)) for i in range(n)]


def test_headers_files_and_inheritance(spark):
    rows = [
        ("a/LICENSE", MIT),
        ("a/b/c/x.py", prose(50, 1)),
        ("a/b/LICENSE", GPL.replace("software", "softwares")),
        ("a/b/y.py", f"{prose(80, 2)}\n  {APACHE.upper()}\n{prose(90, 3)}"),
        ("z.py", "no licence at all here"),
        ("a", "a file called like a directory"),
        ("ab/x.py", prose(20, 4)),
    ]
    got = scan(spark, rows + background())
    assert (got["a/b/c/x.py"].licence, got["a/b/c/x.py"].origin_path) == ("GPL-3.0", "a/b/LICENSE")
    assert (got["a/b/y.py"].licence, got["a/b/y.py"].origin) == ("Apache-2.0", "own")
    assert got["a/LICENSE"].licence == "MIT" and got["a/LICENSE"].origin_path == "a/LICENSE"
    assert all(got[p].licence is None and got[p].origin is None for p in ("z.py", "a", "ab/x.py", "other/p3"))


def test_odd_rows(spark):
    rows = [
        (None, None), (None, MIT), ("", "x"), ("d/x", None), ("d/x", ""), ("d/y", APACHE), ("d/y", APACHE),
        ("d//e", "x"), ("long", prose(30000, 1) + "\n" + MIT),
    ]
    got = scan(spark, rows + background())
    assert len(got) == 5 + 40
    # A licence at the root is everybody's who has none nearer.
    assert got["other/p1"].origin_path == "" and got["d//e"].origin_path == "d/y"
    assert got[""].licence == "MIT" and got["long"].licence == "MIT"
    assert (got["d/x"].licence, got["d/x"].origin_path) == ("Apache-2.0", "d/y")
    assert scan(spark, []) == {}


@pytest.mark.parametrize("directories", [0, 10**6])
def test_the_join_gives_the_same_either_way(spark, monkeypatch, directories):
    small = license_scan.small_enough
    monkeypatch.setattr(license_scan, "small_enough", lambda table: small(table, directories))
    rows = [("s/LICENSE", MIT)] + [(f"s/en/{i}", prose(20, i)) for i in range(200)]
    got = scan(spark, rows + background())
    assert all(got[f"s/en/{i}"].origin_path == "s/LICENSE" for i in range(200))


def test_similarity_is_the_cosine():
    rng = random.Random(2)
    vocabulary = {t for texts in license_scan.TEMPLATES.values() for x in texts for t in license_scan.terms(x)}
    counts = {t: rng.randrange(4) for t in vocabulary}
    matcher = license_scan.Matcher(counts, 100)

    def vector(text):
        return {
            w: n * (math.log(101 / (1 + counts.get(w, 0))) + 1)
            for w, n in Counter(license_scan.terms(text)).items()
        }

    def cosine(a, b):
        norm = math.sqrt(sum(x * x for x in a.values()) * sum(x * x for x in b.values()))
        return sum(x * b.get(w, 0) for w, x in a.items()) / norm

    texts = [text for _, text in license_scan.templates()]
    over = 0
    for _ in range(400):
        words = license_scan.terms(rng.choice(texts))
        line = " ".join(rng.sample(words, rng.randrange(1, len(words) + 1)) + ["unknown"] * rng.randrange(3))
        wanted = max(cosine(vector(line), vector(x)) for x in texts)
        got = matcher.best(license_scan.terms(line))[0]
        over += wanted >= license_scan.LEAST
        # What stays below the least similarity may be passed over.
        assert math.isclose(got, wanted, abs_tol=1e-8) or max(got, wanted) < license_scan.LEAST
    assert over > 50


@pytest.mark.parametrize("counts", ["none", "all", "some"])
def test_passing_over_frequent_terms_loses_no_match(counts):
    """Also where every text holds a notice, so that all its terms are frequent."""
    rng = random.Random(3)
    vocabulary = sorted({t for _, text in license_scan.templates() for t in license_scan.terms(text)})
    held = {t: {"none": 0, "all": 100, "some": rng.randrange(100)}[counts] for t in vocabulary}
    matcher = license_scan.Matcher(held, 100)
    for number, (_, text) in enumerate(license_scan.templates()):
        weights, norm = matcher._vector(license_scan.terms(text))
        silent = {w: x for w, x in weights.items() if w not in matcher.telling[number]}
        assert math.sqrt(sum(x * x for x in silent.values())) / norm < license_scan.LEAST
        assert matcher.telling[number] and matcher.best(license_scan.terms(text))[0] > 0.999999


@pytest.mark.parametrize("every", [2, 1])
def test_a_notice_in_half_of_the_documents_or_all(spark, every):
    rows = [(f"r{i}/f", prose(60, i) + (f"\n{APACHE}" if i % every == 0 else "")) for i in range(100)]
    got = scan(spark, rows)
    assert all((got[f"r{i}/f"].licence == "Apache-2.0") == (i % every == 0) for i in range(100))


def test_wrapped_and_commented_notices(spark):
    rows = []
    for number, (name, text) in enumerate(license_scan.templates()):
        for sign in ("", "# ", " * ", "// "):
            block = "\n".join(sign + line for line in textwrap.wrap(text, 72 - len(sign)))
            body = f"{prose(300, number)}\n{block}\n{sign}\n{prose(300, 100 + number)}"
            rows.append((f"{name}/{number}/{sign.strip() or 'plain'}/f", body))
    got = scan(spark, rows + background())
    assert {path: got[path].licence for path, _ in rows} == {path: path.split("/")[0] for path, _ in rows}
    assert all(got[path].origin == "own" for path, _ in rows)
    assert all(got[f"other/p{i}"].licence is None for i in range(40))


def test_whole_licence_texts(spark):
    rows = []
    for name, text in license_scan.LICENCE_TEXTS.items():
        rows.append((f"{name}/LICENSE", "Copyright (c) 2020 Somebody\n\n" + "\n".join(textwrap.wrap(text, 80))))
        rows.append((f"{name}/src/a.py", prose(40, 3)))
    got = scan(spark, rows + background())
    for name in license_scan.LICENCE_TEXTS:
        assert got[f"{name}/LICENSE"].licence == name
        assert (got[f"{name}/src/a.py"].licence, got[f"{name}/src/a.py"].origin) == (name, "inherited")


def test_every_notice_of_the_test_table_is_found(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    files = docs.selectExpr("cast(doc_id AS string) AS path", "text")
    rows = license_scan.licences(files).collect()
    got = {r.path: r.licence if r.origin == "own" else None for r in rows}
    notices = {name: texts[0] for name, texts in license_scan.TEMPLATES.items()}
    wanted = {
        str(r.doc_id): {name for name, line in notices.items() if line in r.text.split("\n")}
        for r in docs.collect()
    }
    assert sum(bool(w) for w in wanted.values()) > 10
    assert all((got[path] in names) if names else got[path] is None for path, names in wanted.items())
