"""From raw documents to packed sequences, in five stages.

Each stage's table is written as Parquet to shared storage and read again as the
next one's documents. All but the last keep the columns of documents.
"""

from __future__ import annotations

import os
import sys

from pyspark.sql import DataFrame, SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from factloom.llm import bbit, langid, packing, substrings, templates  # noqa: E402
from factloom.llm.queries import tokenizer_path  # noqa: E402
from factloom.sources.staging import scratch_path  # noqa: E402


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents without a letter, and those whose language stays in doubt."""
    return langid.identified(docs, langid.train(docs), least=0.5)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each near-duplicate class: the one with the smallest doc_id.
    Of equal rows one stays."""
    return bbit.keep_first(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes out passages of 50 words and more that an earlier document has."""
    return substrings.cut_texts(docs, substrings.repeats(docs, 50))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a benchmark item."""
    return templates.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs what is left into sequences of at most 1024 tokens."""
    return packing.pack(packing.pieces(docs, tokenizer_path(), 1024), 1024)


STAGES = [
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("repeated_passages", repeated_passages),
    ("decontaminate", decontaminate),
    ("pack", pack),
]

# Tokens, models and hash samples are beyond SQL; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, step in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        step(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
