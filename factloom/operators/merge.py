"""Insert and update a table from a batch of rows.

Rows match on the natural key, NULL-safe. A matched row whose change hash
differs is replaced by the incoming one, a new row is inserted, everything else
stays; nothing is deleted. Where the target holds a key several times, the
incoming row has one action for all of them: if any differs, each of them becomes
the incoming row.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from factloom.functions.hashing import named, quoted, same_key
from factloom.schemas import ROW_HASH, ROW_KEY
from factloom.sources import staging, tables
from factloom.sources.staging import Staged, stage

ACTION = "action"
# How many rows of the target an incoming row replaces, or 1 for an insert.
COPIES = "_copies"
# The natural key as one value, and whether a row comes with the batch.
KEY, NEW = "_key", "_new"


class DuplicateKeys(ValueError):
    """Several incoming rows have the same key."""


@dataclass(frozen=True)
class MergeResult:
    inserted: int
    updated: int
    unchanged: int
    buckets_written: int
    rows_rewritten: int = 0


def _key(keys: Sequence[str]) -> Column:
    """The key columns as one value, never NULL itself: NULL equals NULL inside. A table
    grouped by it lies as a join on it needs, and is shuffled once for both."""
    return F.struct(*map(named, keys))


def duplicate_keys(source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur in several rows, with their number of rows."""
    return source.groupBy(*map(named, keys)).agg(F.count(F.lit(1)).alias("rows")).where("rows > 1")


def latest_per_key(source: DataFrame, keys: Sequence[str], order_by: str) -> DataFrame:
    """One row per key, the one with the greatest ``order_by``. A plain
    aggregate, so copies of a hot key are reduced before they are shuffled."""
    row = F.struct(*map(named, source.columns))
    latest = F.max_by(row, F.struct(named(order_by), ROW_HASH)).alias("row")
    return source.groupBy(*[named(k).alias(f"_key_{k}") for k in keys]).agg(latest).select("row.*")


def classify(target: DataFrame, source: Staged, keys: Sequence[str]) -> DataFrame:
    """The incoming rows with an ``action``: insert, update or unchanged.

    Of the target only the key and the hash are read. A small batch is
    broadcast to the target, which then needs no shuffle; what it finds there is
    reduced to one row per key, and is broadcast back.
    """
    return _with_action(target, source, keys).drop(COPIES)


def _with_action(target: DataFrame, source: Staged, keys: Sequence[str]) -> DataFrame:
    incoming = source.df
    known = target.select(_key(keys).alias(KEY), F.col(ROW_HASH).alias("_known_hash"))
    if source.small:
        wanted = source.df.select(_key(keys).alias("_wanted"))
        known = known.join(F.broadcast(wanted), F.col(KEY) == F.col("_wanted"), "left_semi")
    known = known.groupBy(KEY).agg(
        F.count(F.lit(1)).alias("_found"), F.min("_known_hash").alias("_least"), F.max("_known_hash").alias("_most")
    )
    found = source.side(known)
    joined = incoming.join(found, _key(keys) == found[KEY], "left")
    action = (
        F.when(F.col("_found").isNull(), "insert")
        .when((F.col("_least") != F.col(ROW_HASH)) | (F.col("_most") != F.col(ROW_HASH)), "update")
        .otherwise("unchanged")
    )
    copies = F.coalesce("_found", F.lit(1)).alias(COPIES)
    return joined.select(*[incoming[quoted(c)] for c in incoming.columns], action.alias(ACTION), copies)


def changed_rows(changes: Staged, action: str | None = None) -> DataFrame:
    """The rows to write: each changed row as often as the target had its key."""
    return repeated_rows(changes.df if action is None else changes.df.where(F.col(ACTION) == action))


def repeated_rows(rows: DataFrame) -> DataFrame:
    repeated = F.explode(F.sequence(F.lit(1).cast("long"), F.col(COPIES)))
    return rows.withColumn(COPIES, repeated).drop(ACTION, COPIES)


def kept_rows(target: DataFrame, changes: Staged, keys: Sequence[str]) -> DataFrame:
    """The rows of the target that no change replaces."""
    replaced = changes.side(changes.df.where(F.col(ACTION) == "update").select(*map(named, keys)))
    return target.join(replaced, same_key(target, replaced, keys), "left_anti")


def rewritten_rows(target: DataFrame, updates: DataFrame, rows: int, keys: Sequence[str], buckets: int) -> DataFrame:
    """The rows of the target, with the updates (so many changed rows) in place of those they
    replace, by bucket.

    Up to ``BROADCAST_ROWS`` updates send their surrogate keys to the target: rows with none
    of them stay as they lie, and only the others are shuffled to compare the natural key."""
    updated = repeated_rows(updates)
    if rows <= staging.BROADCAST_ROWS:
        ids = F.broadcast(updates.select(ROW_KEY))
        others = target.join(ids, ROW_KEY, "left_semi").select(*map(named, target.columns))
        replaced = updates.select(*map(named, keys))
        others = others.join(replaced, same_key(others, replaced, keys), "left_anti")
        kept = target.join(ids, ROW_KEY, "left_anti").select(*map(named, target.columns))
        return tables.with_bucket(kept, ROW_KEY, buckets).unionByName(
            tables.gathered(others.unionByName(updated), ROW_KEY, buckets))
    flagged = target.withColumn(NEW, F.lit(False)).unionByName(updated.withColumn(NEW, F.lit(True)))
    dealt = tables.in_ranges(flagged, ROW_KEY, buckets)
    same = Window.partitionBy(tables.BUCKET, ROW_KEY, *map(named, keys))
    return dealt.withColumn("_last", F.max(NEW).over(same)).where(F.col(NEW) == F.col("_last")).drop(NEW, "_last")


def _rounds(counts: Mapping[int, int]) -> list[list[int]]:
    """Buckets by their number of updates, together while these are few enough to be sent."""
    rounds: list[list[int]] = []
    room = 0
    for bucket, rows in sorted(counts.items()):
        if not rounds or rows > room:
            rounds.append([])
            room = staging.BROADCAST_ROWS
        rounds[-1].append(bucket)
        room -= rows
    return rounds


def stage_changes(target: DataFrame, source: Staged, keys: Sequence[str]) -> tuple[Staged, MergeResult]:
    """Keep of the incoming rows those that insert or update, and count them."""
    counted = stage(
        _with_action(target, source, keys).where(F.col(ACTION) != "unchanged"),
        "changes",
        {
            "inserted": F.count_if(F.col(ACTION) == "insert"),
            "updated": F.count_if(F.col(ACTION) == "update"),
        },
        compression="zstd",
    )
    inserted, updated = counted.metrics["inserted"], counted.metrics["updated"]
    return counted, MergeResult(inserted, updated, source.rows - inserted - updated, 0)


def stage_source(source: DataFrame, keys: Sequence[str], dedupe_by: str | None = None) -> Staged:
    """Write the enriched batch once, for all the steps of a merge."""
    if dedupe_by is not None:
        source = latest_per_key(source, keys, dedupe_by)
    staged = stage(source, "source", compression="zstd")
    # Hashes are shuffled instead of keys; keys are compared only if a hash occurs twice.
    hashes = staged.df.groupBy(F.xxhash64(*map(named, keys))).count()
    if dedupe_by is None and not hashes.where("count > 1").isEmpty():
        clashes = duplicate_keys(staged.df, keys).limit(20).collect()
        if clashes:
            raise DuplicateKeys(f"several incoming rows per key, such as {clashes}")
    return staged


def merge_plan(
    target: DataFrame, source: DataFrame, keys: Sequence[str], dedupe_by: str | None = None
) -> tuple[DataFrame, MergeResult]:
    """The merged rows and the counts, for a target given as a DataFrame. Both
    sides carry ``row_hash``."""
    staged = stage_source(source, keys, dedupe_by)
    changes, result = stage_changes(target, staged, keys)
    return kept_rows(target, changes, keys).unionByName(changed_rows(changes)), result


def apply_merge(
    spark: SparkSession,
    path: str,
    source: DataFrame,
    keys: Sequence[str],
    dedupe_by: str | None = None,
) -> MergeResult:
    """Merge a batch into the table at ``path``. Reads the hashes of the buckets
    the batch touches, rewrites the buckets in which a row is updated, and appends
    what is new. If it is stopped between the two, the same merge completes it."""
    staged = stage_source(source, keys, dedupe_by)
    buckets = tables.bucket_count(spark, path)
    touched = _buckets(staged.df, buckets)
    changes, result = stage_changes(tables.read_current(spark, path, touched), staged, keys)
    if not changes.rows:
        return result
    dirty, rewritten = [], 0
    if result.updated:
        place = tables.bucket_of(ROW_KEY, buckets)
        updates = changes.df.where(F.col(ACTION) == "update")
        if changes.small:
            dirty = _buckets(updates, buckets)
            # Few changes are broadcast, so the kept rows still lie by bucket as read.
            kept = kept_rows(tables.read_current(spark, path, dirty), changes, keys)
            rewritten = tables.replace_buckets(kept, changed_rows(changes, "update"), path, ROW_KEY, in_place=True)
        else:
            # At most as many numbers as the table has buckets.
            counts = {row.b: row["count"] for row in updates.groupBy(place.alias("b")).count().collect()}
            dirty = sorted(counts)
            rewritten = tables.replace_in_rounds(
                spark, path,
                [rewritten_rows(
                    tables.read_current(spark, path, some), updates.where(place.isin(some)),
                    sum(counts[b] for b in some), keys, buckets)
                 for some in _rounds(counts)])
    if result.inserted:
        tables.append(changed_rows(changes, "insert"), path, ROW_KEY)
    return MergeResult(result.inserted, result.updated, result.unchanged, len(dirty), rewritten)


def _buckets(df: DataFrame, buckets: int) -> list[int]:
    """The distinct buckets of the rows; at most as many as the table has."""
    found = df.select(tables.bucket_of(ROW_KEY, buckets).alias("b")).distinct()
    return sorted(row.b for row in found.collect())
