from __future__ import annotations

import numpy as np
import pytest

from blotter.llm import line_dedup
from tests.llm import brute
from tests.llm.conftest import ODD_ROWS


def expected(rows):
    return sorted(
        ((i, n, d, brute.sha(k)) for i, n, d, k in brute.dedup_lines([(r[0], r[1]) for r in rows])),
        key=repr,
    )


def report(docs):
    return sorted((tuple(r) for r in line_dedup.line_report(docs).collect()), key=repr)


def test_keeps_the_first_holder_only(documents):
    line = "The same line, long enough"
    rows = [
        (3, f"{line}\nown of three\n  {line.upper()}\t"),
        (1, f"short\n{line}\n{line}\nshort"),
        (2, f"short\n\v{line.upper()} \r\nthe last one of two"),
        (9, "nine char\nten chars!\nÀNOTHER LINE"),
        (8, "nine char\nten chars!\nànother line"),
    ]
    assert report(documents(*rows)) == expected(rows)


def test_odd_rows(documents):
    assert report(documents(*ODD_ROWS)) == expected(ODD_ROWS)


def test_empty_table(documents):
    assert report(documents(*ODD_ROWS).limit(0)) == []


@pytest.mark.parametrize("partitions", [1, 7])
def test_a_hot_line_spans_partitions(spark, documents, partitions):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        rows = [(i, f"the hot line of all documents\nown line number {i % 40}") for i in range(500)]
        assert report(documents(*rows)) == expected(rows)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_a_very_long_text(documents):
    rows = [(1, "\n".join(f"line number {i % 3000}" for i in range(20000))), (2, "line number 17\nx")]
    assert report(documents(*rows)) == expected(rows)


def test_bitmaps_round_trip_and_carry_no_text(documents):
    bits = line_dedup.pack_keep(1000, np.array([0, 17, 999]))
    kept = line_dedup.unpack_keep(bits, 1000)
    assert kept.sum() == 997 and not kept[[0, 17, 999]].any() and len(bits) < 60
    bitmaps = line_dedup.keep_bitmaps(documents("some line of words\nb", "some line of words\nc"))
    assert dict(bitmaps.dtypes)["keep"] == "binary" and "string" not in dict(bitmaps.dtypes).values()
    assert sorted((r.n_lines, r.n_dropped, r.keep is None) for r in bitmaps.collect()) == [
        (2, 0, True), (2, 1, False),
    ]


def test_documents_keep_their_columns(documents):
    docs = documents((1, "a line that repeats\nx"), (2, "a line that repeats\ny"), (3, None))
    out = line_dedup.dedup_lines(docs)
    assert out.schema.names == docs.schema.names
    rows = {r.doc_id: r for r in out.collect()}
    assert (rows[2].text, rows[2].n_chars, rows[2]._id) == ("y", 1, -7)
    assert rows[1].text == "a line that repeats\nx" and rows[3].text is None
