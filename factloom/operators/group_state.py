"""Group maxima over a whole table, kept up to date at the cost of what a batch moves.

Beside the table lies its state: for each group the maximum, and how many rows have it.
A batch adds and takes away values; from their counts per group and value follows the
new maximum of every group it touches. Only where the last row at the maximum went away
without a larger one, that group is looked through again. Rows are given a new maximum
and a new change hash only in groups whose maximum moved.

The table must hold maxima over the whole table, as a full load leaves it.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from factloom.functions.hashing import row_hash, same_key, with_keys
from factloom.operators.merge import apply_merge, stage_source
from factloom.schemas import ROW_HASH, ROW_KEY
from factloom.sources import tables
from factloom.sources.staging import Staged, stage

GROUP, TOP, AT_TOP = "group_key", "top", "at_top"


@dataclass(frozen=True)
class Moved:
    """What a batch did: rows inserted and updated by it, groups whose maximum moved,
    other rows that got a new maximum, and groups that had to be looked through."""

    inserted: int
    updated: int
    unchanged: int
    groups_moved: int
    rows_moved: int
    groups_rescanned: int


def _tops(counted: DataFrame) -> DataFrame:
    """(group_key, top, at_top) from numbers ``n`` per group and value."""
    best = counted.groupBy(GROUP).agg(F.max(F.struct(F.col("value"), F.col("n"))).alias("b"))
    return best.select(GROUP, F.col("b.value").alias(TOP), F.col("b.n").alias(AT_TOP))


def _counted(rows: DataFrame, group: str, value: str) -> DataFrame:
    """Rows per group and value; reduced in the tasks, whatever the size of a group."""
    return rows.groupBy(F.col(group).alias(GROUP), F.col(value).alias("value")).agg(F.count(F.lit(1)).alias("n"))


def build(rows: DataFrame, state: str, group: str, value: str, buckets: int = 8) -> int:
    """Write the state of all rows; return the number of groups."""
    return tables.overwrite(with_keys(_tops(_counted(rows, group, value)), [GROUP]), state, ROW_KEY, buckets)


def merge(
    spark: SparkSession,
    table: str,
    state: str,
    batch: DataFrame,
    keys: Sequence[str],
    group: str,
    value: str,
    out: str,
    dedupe_by: str | None = None,
) -> Moved:
    """Merge a batch into the table and leave in ``out`` each group's maximum over the whole
    table. The state goes last: after a merge that was stopped between the two, ``build`` it
    anew before the next."""
    batch = batch.select([c for c in batch.columns if c not in (out, ROW_KEY, ROW_HASH)])
    payload = [c for c in batch.columns if c not in keys]
    source = stage_source(batch.withColumns({ROW_KEY: row_hash(keys), ROW_HASH: row_hash(payload)}), keys, dedupe_by)
    target = tables.read_current(spark, table)
    changes = _changes(target, source, keys, payload, group, value)
    counts = lambda g, v, n: F.struct(g.alias(GROUP), v.alias("value"), n.cast("long").alias("n"))
    gone = F.transform(F.coalesce("old", F.array()), lambda x: counts(x["g"], x["v"], F.lit(-1)))
    deltas = changes.df.select(F.explode(F.concat(F.array(counts(F.col(group), F.col(value), F.col("copies"))), gone)).alias("d")).select("d.*")
    # Also where they cancel out: the rows still need the maximum of their group.
    deltas = deltas.groupBy(GROUP, "value").agg(F.sum("n").alias("n"))
    deltas = stage(deltas, "value-changes")
    before, after, unknown = _next_state(spark, state, deltas)
    rescanned = 0
    if unknown.rows:
        again, rescanned = _rescan(target, changes, unknown, keys, group, value), unknown.rows
        after = stage(after.df.join(unknown.side(), after.df[GROUP].eqNullSafe(F.col("_unknown")), "left_anti").unionByName(again), "next-state")
    moved = after.df.alias("a").join(before.df.alias("b"), F.col(f"a.{GROUP}").eqNullSafe(F.col(f"b.{GROUP}")), "left")
    moved = moved.where(~F.col(f"a.{TOP}").eqNullSafe(F.col(f"b.{TOP}"))).select(F.col(f"a.{GROUP}").alias("_group"), F.col(f"a.{TOP}").alias("_top"))
    moved = stage(moved, "moved-groups")

    # What the batch changes, and what a moved maximum changes, in one merge.
    known = after.side(after.df.select(F.col(GROUP).alias("_group"), F.col(TOP).alias(out)))
    own = changes.df.select(*batch.columns).join(known, F.col(group).eqNullSafe(F.col("_group")), "left").drop("_group")
    others = target.drop(out, ROW_KEY, ROW_HASH).join(moved.side(), F.col(group).eqNullSafe(F.col("_group"))).withColumnRenamed("_top", out).drop("_group")
    touched = changes.side(changes.df.select(*keys))
    others = others.join(touched, same_key(others, touched, keys), "left_anti").dropDuplicates(list(keys))
    rows = own.unionByName(others.select(own.columns))
    order = [c for c in target.columns if c not in (ROW_KEY, ROW_HASH)]
    done = apply_merge(spark, table, with_keys(rows.select(order), keys), keys)
    inserted, updated = changes.metrics["inserted"], changes.metrics["updated"]
    if after.rows:
        apply_merge(spark, state, with_keys(after.df, [GROUP]), [GROUP])
    return Moved(inserted, updated, source.rows - inserted - updated, moved.rows, done.updated - updated, rescanned)


def _changes(target: DataFrame, source: Staged, keys: Sequence[str], payload: Sequence[str], group: str, value: str) -> Staged:
    """The incoming rows that are new or differ, with what they replace. The measure itself is
    no difference."""
    wanted = source.side(source.df.select(*[F.col(k).alias(f"_{k}") for k in keys]))
    same = F.lit(True)
    for key in keys:
        same = same & F.col(key).eqNullSafe(F.col(f"_{key}"))
    held = target.withColumn("_hash", row_hash(payload)).join(wanted, same, "left_semi")
    held = held.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("old_rows"), F.min("_hash").alias("_lo"), F.max("_hash").alias("_hi"),
        F.collect_list(F.struct(F.col(group).alias("g"), F.col(value).alias("v"))).alias("old"))  # as many as the key has rows
    held = source.side(held)
    joined = source.df.join(held, same_key(source.df, held, keys), "left")
    new = F.col("old_rows").isNull()
    joined = joined.where(new | (F.col("_lo") != F.col(ROW_HASH)) | (F.col("_hi") != F.col(ROW_HASH)))
    none = F.lit(0).cast("long")
    return stage(joined.select(
        *[source.df[c] for c in source.df.columns], F.coalesce("old_rows", none).alias("old_rows"), F.coalesce("old_rows", none + 1).alias("copies"),
        "old"), "changes", {"inserted": F.count_if(F.col("old_rows") == 0), "updated": F.count_if(F.col("old_rows") > 0)})


def _next_state(spark: SparkSession, state: str, deltas: Staged) -> tuple[Staged, Staged, Staged]:
    """The state of the touched groups before and after, and the groups whose next maximum
    cannot be told from it."""
    groups = stage(deltas.df.select(F.col(GROUP).alias("_g")).distinct(), "touched-groups")
    before = tables.read_current(spark, state).join(groups.side(), F.col(GROUP).eqNullSafe(F.col("_g")), "left_semi")
    before = stage(before.select(GROUP, TOP, AT_TOP), "state-before")
    added = deltas.df.where("n > 0").groupBy(GROUP).agg(F.max(F.struct("value", "n")).alias("most"))
    joined = groups.df.join(before.side(), F.col("_g").eqNullSafe(F.col(GROUP)), "left").drop(GROUP)
    added = added.withColumnRenamed(GROUP, "_a")
    joined = joined.join(groups.side(added), F.col("_g").eqNullSafe(F.col("_a")), "left")
    at_top = deltas.df.select(F.col(GROUP).alias("_d"), F.col("value").alias("_v"), F.col("n").alias("_n"))
    joined = joined.join(deltas.side(at_top), F.col("_g").eqNullSafe(F.col("_d")) & F.col(TOP).eqNullSafe(F.col("_v")), "left")
    rises = F.col("most").isNotNull() & (F.col(AT_TOP).isNull() | F.coalesce(F.col("most.value") > F.col(TOP), F.col(TOP).isNull() & F.col("most.value").isNotNull()))
    left: Column = F.coalesce(AT_TOP, F.lit(0)) + F.coalesce("_n", F.lit(0))
    after = joined.select(
        F.col("_g").alias(GROUP), F.when(rises, F.col("most.value")).otherwise(F.col(TOP)).alias(TOP),
        F.when(rises, F.col("most.n")).otherwise(left).alias(AT_TOP))
    after = stage(after, "state-after", {"open": F.count_if(F.col(AT_TOP) <= 0)})
    unknown = stage(after.df.where(F.col(AT_TOP) <= 0).select(F.col(GROUP).alias("_unknown")), "open-groups")
    return before, after, unknown


def _rescan(target: DataFrame, changes: Staged, unknown: Staged, keys: Sequence[str], group: str, value: str) -> DataFrame:
    """The state of some groups from their rows, as they are after the batch."""
    touched = changes.side(changes.df.select(*keys))
    kept = target.join(touched, same_key(target, touched, keys), "left_anti").select(group, value)
    copies = changes.df.withColumn("_c", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))).select(group, value)
    rows = kept.unionByName(copies).join(unknown.side(), F.col(group).eqNullSafe(F.col("_unknown")), "left_semi")
    found = _tops(_counted(rows, group, value))
    # A group without rows keeps a state of none.
    return unknown.df.join(found, F.col("_unknown").eqNullSafe(F.col(GROUP)), "left").select(
        F.col("_unknown").alias(GROUP), TOP, F.coalesce(AT_TOP, F.lit(0).cast("long")).alias(AT_TOP))
