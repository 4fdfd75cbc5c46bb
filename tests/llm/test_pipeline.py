from __future__ import annotations

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import __spark_entry__ as contract
import corpus_pipeline
from blotter.llm import packing, quality_rules
from checks import compare
from tests.conftest import SMALL
from tests.llm import brute

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_stages_equal_brute_force(spark, tmp_path):
    given = spark.read.parquet(f"{SMALL}/documents.parquet")
    wanted = {r.doc_id for r in quality_rules.quality_report(given).where("kept").collect()}
    rows = [(r.doc_id, r.text) for r in given.collect() if r.doc_id in wanted]
    docs = given
    for number, (name, stage) in enumerate(corpus_pipeline.STAGES[:-1]):
        if number == 1:
            rows = [(i, kept) for i, _, _, kept in brute.dedup_lines(rows)]
        if number == 2:
            least = brute.classes(rows)
            rows = [(i, t) for i, t in rows if least[i] == i]
        if number == 3:
            cut = brute.cut_repeats(rows)
            rows = [(i, kept if gone else t) for (i, t), (_, _, gone, kept) in zip(rows, cut)]
        stage(spark, docs, SMALL).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        assert docs.columns == COLUMNS
        got = docs.collect()
        assert sorted((r.doc_id, r.text) for r in got) == sorted(rows), name
        assert all(r.n_chars == len(r.text) for r in got)
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    tokenizer.encode_special_tokens = True
    total = sum(len(tokenizer.encode(t, add_special_tokens=False).ids) + 1 for _, t in rows)
    sequences = corpus_pipeline.STAGES[-1][1](spark, docs, SMALL).collect()
    assert sum(s.length for s in sequences) == total
    assert {i for s in sequences for i in s.doc_ids} == {i for i, _ in rows}
    assert all(s.length <= packing.CAPACITY for s in sequences)
    assert len(sequences) <= -(-total // packing.CAPACITY) * 1.02 + 1


def test_odd_rows_run_through(spark, documents, tmp_path):
    from tests.llm.conftest import ODD_ROWS, prose

    nameless = [(None, prose(150, 900), "en", "s")] * 2 + [(None, prose(150, 901), "en", "s")]
    docs = documents(*ODD_ROWS, *nameless, *((100 + n, prose(100, n)) for n in range(20, 40)))
    for table in (docs, docs.limit(0)):
        given = table.count()
        for name, stage in corpus_pipeline.STAGES:
            folder = str(tmp_path / str(len(list(tmp_path.iterdir()))))
            stage(spark, table, SMALL).write.parquet(folder)
            table = spark.read.parquet(folder)
            if given and name == "substring_dedup":
                left = [(r.doc_id, r.text) for r in table.collect()]
        if given:
            # Of repeated rows one is left, whole; rows without an id are told apart by their text.
            for row in [(4, prose(120, 1)), (None, prose(150, 900)), (None, prose(150, 901))]:
                words = row[1].split()
                assert [t.split() for i, t in left if i == row[0] and t.split()[:5] == words[:5]] == [words]


def test_run_is_registered(spark):
    assert contract.queries()["pipeline"] is corpus_pipeline.run
    assert corpus_pipeline.run(spark, SMALL).where(F.col("length") > 0).count() > 0


@pytest.mark.parametrize("name", sorted(n for n in contract.oracle_sql() if n.startswith("op")))
def test_query_equals_sql(spark, name):
    ours = contract.queries()[name](spark, SMALL).toPandas()
    connection = compare.duck(SMALL)
    assert compare.differences(ours, connection.sql(contract.oracle_sql()[name]).df()) == []


def test_every_operator_is_registered():
    numbers = {int(n[2:].split("_")[0]) for n in contract.queries() if n.startswith("op")}
    assert numbers == set(range(1, 14))
