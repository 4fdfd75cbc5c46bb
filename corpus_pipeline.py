"""A corpus from raw documents to training sequences, stage by stage."""

from __future__ import annotations

from uuid import uuid4

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from blotter.llm import line_dedup, ngram_join, packing, quality_rules, substring_dedup
from blotter.llm.common import prepare, shared_folder


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules, judged against their language and source."""
    prepare(spark)
    return quality_rules.keep_good(docs)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, without the lines that one with a smaller id has too."""
    prepare(spark)
    return line_dedup.dedup_lines(docs)


def keep_one_of_similar(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near copies the document with the smallest id."""
    prepare(spark)
    return ngram_join.keep_one(docs)


def cut_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, without the words of passages that begin anywhere else too."""
    prepare(spark)
    return substring_dedup.remove_repeats(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Training sequences: sequence_id, length, ids, and the doc_ids and offsets of their pieces."""
    prepare(spark)
    packed = packing.pack(
        docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    )
    return packed.sequences()


STAGES = [
    ("quality_rules", keep_good),
    ("line_dedup", drop_repeated_lines),
    ("ngram_join", keep_one_of_similar),
    ("substring_dedup", cut_repeated_passages),
    ("packing", pack_sequences),
]

# Sketches, an index and bin packing are beyond SQL; the tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every stage over `documents`; each one's rows are written before the next one reads them."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = f"{shared_folder(spark)}/blotter-llm/{uuid4().hex}"
    for name, stage in STAGES:
        path = f"{folder}/{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
