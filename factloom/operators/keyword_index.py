"""Keyword filters that read only the documents a keyword can be in.

A stored collection lies in groups, each a folder of its own, and beside it the index:
which character trigrams occur in which group, ``(gram, doc_group)`` sorted by gram. A
text holds a keyword only if its group holds every trigram of it, so the other groups
are skipped before any of their text is read. What is left is tested on the text, by the
same test as without an index: the result is exact, and keywords without three letters
in a row between wildcards skip nothing.

NULL documents are stored and never found. Groups are cut by rows in the order of
``cluster_by``; a large value spreads over several groups. How much is skipped follows
from how much the texts of one group have in common.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from factloom.functions.hashing import named
from factloom.functions.text import contains_all, plain_keyword

GROUP, GRAM = "doc_group", "gram"
LENGTH = 3


@dataclass(frozen=True)
class Found:
    """The documents, and how many of the groups were looked at to find them."""

    df: DataFrame
    groups: int
    read: int


def build(docs: DataFrame, path: str, groups: int, cluster_by: Sequence[str], text: str = "document") -> None:
    """Store the documents in about ``groups`` groups, and their index. Choose the number
    so that a group is a few hundred megabytes."""
    spark = docs.sparkSession
    dealt = docs.repartitionByRange(groups, *map(named, cluster_by))
    dealt.withColumn(GROUP, F.spark_partition_id()).write.partitionBy(GROUP).parquet(_docs(path))
    # A partitioned write of no rows leaves no file that tells the columns.
    docs.limit(0).write.parquet(_columns(path))
    texts = _stored(spark, path).where(named(text).isNotNull()).select(GROUP, F.lower(named(text)).alias("text"))
    # A gram is reduced to once per group in each batch and task, before the shuffle.
    pairs = texts.mapInArrow(_grams, f"{GROUP} int, {GRAM} string").distinct()
    pairs.repartitionByRange(GRAM).sortWithinPartitions(GRAM, GROUP).write.parquet(_index(path))


def _stored(spark: SparkSession, path: str) -> DataFrame:
    columns = spark.read.parquet(_columns(path)).schema
    schema = T.StructType([*columns.fields, T.StructField(GROUP, T.IntegerType())])
    return spark.read.schema(schema).parquet(_docs(path))


def _columns(path: str) -> str:
    return f"{path}/columns"


def _docs(path: str) -> str:
    return f"{path}/documents"


def _index(path: str) -> str:
    return f"{path}/grams"


def _grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The different trigrams of each group's texts in a batch, read one by one."""
    for batch in batches:
        found: dict[int, set[str]] = {}
        for group, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            found.setdefault(group, set()).update(grams_of(text.as_py()))
        for group, grams in found.items():
            yield pa.record_batch([pa.array([group] * len(grams), pa.int32()), pa.array(grams, pa.string())], [GROUP, GRAM])


def grams_of(text: str) -> set[str]:
    return {text[i : i + LENGTH] for i in range(len(text) - LENGTH + 1)}


def needed_grams(spark: SparkSession, keywords: Sequence[str], literal: bool = False) -> set[str]:
    """Trigrams that every text with all the keywords has: those of the stretches
    between wildcards, in the lower case of the test itself."""
    plain = [plain_keyword(k, literal) for k in keywords]
    if not plain:
        return set()
    lowered = spark.range(1).select(*[F.lower(F.lit(p)) for p in plain]).first()
    stretches = [s for word in lowered for s in ([word] if literal else re.split("[%_]", word))]
    return set().union(*map(grams_of, stretches))


def groups_with(spark: SparkSession, path: str, grams: set[str]) -> list[int]:
    """The groups that hold every gram: at most one number per group comes to the driver."""
    index = spark.read.parquet(_index(path))
    held = index.where(F.col(GRAM).isin(sorted(grams))).groupBy(GROUP).agg(F.count(F.lit(1)).alias("n"))
    return sorted(row[GROUP] for row in held.where(F.col("n") == len(grams)).select(GROUP).collect())


def find(
    spark: SparkSession, path: str, keywords: Sequence[str], literal: bool = False, text: str = "document"
) -> Found:
    """The documents that hold every keyword, as ``contains_all`` tests them."""
    stored = _stored(spark, path)
    total = stored.select(GROUP).distinct().count()
    grams = needed_grams(spark, keywords, literal)
    read = total
    if grams:
        groups = groups_with(spark, path, grams)
        read = len(groups)
        stored = stored.where(F.col(GROUP).isin(groups))
    found = stored.where(contains_all(named(text), keywords, literal)).drop(GROUP)
    return Found(found, total, read)
