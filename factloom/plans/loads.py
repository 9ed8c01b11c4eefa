"""Load jobs: full load, merge load, documents with vectors."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from factloom.functions.text import PLAYER_SENTENCE, sentence
from factloom.operators import vector_store
from factloom.operators.embed import EmbedderFactory, HashingEmbedder, embed, embed_distinct
from factloom.operators.enrich import enrich
from factloom.operators.merge import MergeResult, apply_merge
from factloom.schemas import DOCUMENT, GROUP_MAX, ROW_HASH, ROW_KEY, SRC, VECTOR
from factloom.sources import tables
from factloom.sources.landing import read_landing
from factloom.sources.staging import stage


@dataclass(frozen=True)
class LoadSpec:
    """What a load needs to know about a data set."""

    schema: T.StructType | None = SRC
    keys: Sequence[str] = ("player_name", "match_id")
    group: str = "team"
    value: str = "goals"
    group_max: str = GROUP_MAX
    sentence: Sequence[str] = PLAYER_SENTENCE
    buckets: int = tables.DEFAULT_BUCKETS
    # Landing files: which ones, whether a field may hold line breaks, and what a bad value does.
    pattern: str = "*.csv"
    multi_line: bool = True
    mode: str = "FAILFAST"
    # Whether files with such line breaks are read by several tasks each.
    split: bool = False

    def read(self, spark: SparkSession, landing: str) -> DataFrame:
        return read_landing(
            spark, landing, self.schema, self.pattern, multi_line=self.multi_line, mode=self.mode, split=self.split
        )

    def enrich(self, df: DataFrame) -> DataFrame:
        return enrich(df, self.keys, self.group, self.value, self.group_max)


def initial_load(df: DataFrame, table: str, spec: LoadSpec = LoadSpec()) -> int:
    """Replace the table by the enriched rows; return how many there are."""
    return tables.overwrite(spec.enrich(df), table, ROW_KEY, spec.buckets)


def delta_load(
    df: DataFrame,
    table: str,
    spec: LoadSpec = LoadSpec(),
    dedupe_by: str | None = None,
    recompute_group_measures: bool = False,
) -> MergeResult:
    """Merge the enriched rows into the table.

    The group maximum is that of the incoming rows. ``recompute_group_measures``
    afterwards takes it over the whole table instead, which rewrites the table.
    """
    spark = df.sparkSession
    result = apply_merge(spark, table, spec.enrich(df), spec.keys, dedupe_by)
    if recompute_group_measures:
        merged = tables.read_current(spark, table).drop(spec.group_max, ROW_KEY, ROW_HASH)
        tables.overwrite(spec.enrich(merged), table, ROW_KEY, tables.bucket_count(spark, table))
    return result


def build_vectors(
    raw: DataFrame,
    table: str,
    spec: LoadSpec = LoadSpec(),
    make_embedder: EmbedderFactory = HashingEmbedder,
    distinct: bool = True,
    tasks: int | None = None,
    skip_nulls: bool = False,
) -> int:
    """Write the rows with their sentence and its vector; return the row count.
    Decimals become doubles. With ``distinct`` equal sentences are embedded
    once."""
    documents = with_sentence(raw, spec, skip_nulls)
    if distinct:
        vectors = embed_distinct(documents, DOCUMENT, VECTOR, make_embedder, tasks)
    else:
        vectors = embed(documents, DOCUMENT, VECTOR, make_embedder)
    return tables.overwrite(vectors, table, ROW_KEY, spec.buckets)


def with_sentence(raw: DataFrame, spec: LoadSpec, skip_nulls: bool = False) -> DataFrame:
    """The rows with their sentence; decimals become doubles."""
    plain = raw.select(
        [
            F.col(f.name).cast("double") if isinstance(f.dataType, T.DecimalType) else F.col(f.name)
            for f in raw.schema.fields
        ]
    )
    return plain.withColumn(DOCUMENT, sentence(spec.sentence, skip_nulls))


@dataclass(frozen=True)
class VectorRefresh:
    """What a refresh did: texts given to the model, and rows written to the vector table."""

    embedded: int
    merged: MergeResult


def refresh_vectors(
    raw: DataFrame,
    table: str,
    store: str,
    model: str,
    spec: LoadSpec = LoadSpec(),
    make_embedder: EmbedderFactory = HashingEmbedder,
    tasks: int | None = None,
    skip_nulls: bool = False,
) -> VectorRefresh:
    """Bring the vector table up to date with the raw rows, at the cost of what changed.

    The change hash of a vector row covers the raw row's hash and the model's version.
    Only raw rows whose hash is not there yet get a sentence; only sentences the
    vector store lacks are given to the model; and only their rows are merged into the
    table. Rows that vanished from the raw table stay, as in any merge.
    """
    spark = raw.sparkSession
    hashed = raw.withColumn(ROW_HASH, row_hash_with(model))
    known = None
    if tables.exists(spark, table):
        known = tables.read_current(spark, table).select(ROW_KEY, F.col(ROW_HASH).alias("_known"))
        # Without shuffle of payload: only keys and hashes of the table are read.
        same = known.select(F.col(ROW_KEY).alias("_key"), "_known").distinct()
        hashed = hashed.join(same, (F.col(ROW_KEY) == F.col("_key")) & (F.col(ROW_HASH) == F.col("_known")), "left_anti")
    changed = stage(with_sentence(hashed, spec, skip_nulls), "changed-rows")
    done = vector_store.refresh(changed.df, DOCUMENT, store, model, make_embedder, tasks)
    rows = vector_store.with_vectors(changed.df, DOCUMENT, store, model, VECTOR)
    if known is None:
        written = tables.overwrite(rows, table, ROW_KEY, spec.buckets)
        return VectorRefresh(done.embedded, MergeResult(written, 0, 0, 0))
    return VectorRefresh(done.embedded, apply_merge(spark, table, rows, spec.keys))


def row_hash_with(model: str) -> Column:
    """The raw row's hash together with the model's version."""
    return F.xxhash64(F.col(ROW_HASH), F.lit(model))


@dataclass(frozen=True)
class RunResult:
    loaded: int
    merged: MergeResult
    documents: int


def run(
    spark: SparkSession,
    landing: str,
    raw_table: str,
    vector_table: str,
    spec: LoadSpec = LoadSpec(),
    make_embedder: EmbedderFactory = HashingEmbedder,
) -> RunResult:
    """All load steps in order. The first failing step ends the run. The landing
    files are parsed and enriched once, for both loads."""
    rows = stage(spec.enrich(spec.read(spark, landing)), "enriched").df
    loaded = tables.overwrite(rows, raw_table, ROW_KEY, spec.buckets)
    merged = apply_merge(spark, raw_table, rows, spec.keys)
    raw = tables.read_current(spark, raw_table)
    return RunResult(loaded, merged, build_vectors(raw, vector_table, spec, make_embedder))
