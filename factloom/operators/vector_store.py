"""Vectors of texts, kept across loads.

The store is a table of ``(row_sk, text_id, model, vector)``. A text is addressed by
the 128-bit MD5 of its bytes, and a vector belongs to one version of a model. A
refresh looks up which texts of a batch the store lacks, gives only these to the
model, each once, and appends their vectors; nothing stored is read but the ids, and
nothing is rewritten. Texts and vectors are never shuffled together with their rows:
rows carry the id, and vectors join on it.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from factloom.functions.hashing import row_hash
from factloom.operators.embed import EmbedderFactory, HashingEmbedder, embed
from factloom.schemas import ROW_KEY
from factloom.sources import tables
from factloom.sources.staging import stage

TEXT_ID, MODEL, STORED = "text_id", "model", "vector"
STORE = T.StructType([
    T.StructField(TEXT_ID, T.StringType()), T.StructField(MODEL, T.StringType()),
    T.StructField(STORED, T.ArrayType(T.FloatType())), T.StructField(ROW_KEY, T.LongType()),
])


@dataclass(frozen=True)
class Refreshed:
    """Different texts that were asked for, and how many of them the model was given."""

    texts: int
    embedded: int


def text_id(text: Column) -> Column:
    """32 hexadecimal digits; NULL for NULL."""
    return F.md5(text)


def _keyed(ids: DataFrame, model: str) -> DataFrame:
    return ids.withColumn(MODEL, F.lit(model)).withColumn(ROW_KEY, row_hash([TEXT_ID, MODEL]))


def refresh(
    rows: DataFrame,
    text: str,
    store: str,
    model: str,
    make_embedder: EmbedderFactory = HashingEmbedder,
    tasks: int | None = None,
    buckets: int = tables.DEFAULT_BUCKETS,
) -> Refreshed:
    """Make the store hold the vector of every ``text`` of the rows. ``model`` names the
    model's version: another version's vectors do not count. Stopped half-way, the
    same call completes it: vectors are there as a whole batch or not at all.
    ``tasks`` spreads a slow model."""
    spark = rows.sparkSession
    if not tables.exists(spark, store):
        tables.create_or_replace(spark, store, STORE, buckets)
    # Copies of a text are reduced in the tasks; the text travels with its id once.
    asked = rows.where(F.col(text).isNotNull()).select(text_id(F.col(text)).alias(TEXT_ID), F.col(text).alias("_text"))
    asked = stage(_keyed(asked.groupBy(TEXT_ID).agg(F.any_value("_text").alias("_text")), model), "asked-texts")
    known = tables.read_current(spark, store).where(F.col(MODEL) == model).select(ROW_KEY, TEXT_ID)
    if asked.small:
        # A small batch goes to the store, which then needs no shuffle.
        known = known.join(F.broadcast(asked.df.select(TEXT_ID)), TEXT_ID, "left_semi")
    missing = stage(asked.df.join(known.select(TEXT_ID), TEXT_ID, "left_anti"), "missing-texts")
    if missing.rows:
        texts = missing.df.repartition(tasks) if tasks else missing.df
        made = embed(texts, "_text", STORED, make_embedder)
        tables.append(made.select(TEXT_ID, MODEL, STORED, ROW_KEY), store, ROW_KEY)
    return Refreshed(asked.rows, missing.rows)


def with_vectors(rows: DataFrame, text: str, store: str, model: str, out: str) -> DataFrame:
    """The rows with the stored vector of their text; NULL where there is none.
    A hot text is split by adaptive execution."""
    spark = rows.sparkSession
    held = tables.read_current(spark, store).where(F.col(MODEL) == model)
    held = held.select(F.col(TEXT_ID).alias("_id"), F.col(STORED).alias(out))
    return rows.join(held, text_id(F.col(text)) == F.col("_id"), "left").drop("_id")


def forget(spark: SparkSession, store: str, keep: list[str]) -> int:
    """Keep only the vectors of the given model versions; return how many there are."""
    kept = tables.read_current(spark, store).where(F.col(MODEL).isin(keep))
    return tables.overwrite(kept, store, ROW_KEY, tables.bucket_count(spark, store))
