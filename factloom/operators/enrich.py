"""Group measures and keys for incoming rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from factloom.functions.hashing import named, with_keys
from factloom.schemas import GROUP_MAX
from factloom.sources.staging import stage


def group_max(df: DataFrame, group: str, value: str, out: str) -> DataFrame:
    """Add the maximum of ``value`` over all rows with the same ``group``.

    As ``max(value) OVER (PARTITION BY group)``, which would send all rows of a
    group to one task. Here each task reduces its rows to one per group, and
    the small result is joined back: broadcast if it was measured small, so the
    rows themselves are not shuffled; else by a shuffled join, in which
    adaptive execution splits a hot group over several tasks.
    """
    peaks = stage(df.groupBy(named(group).alias("_group")).agg(F.max(named(value)).alias(out)), "group-max")
    return df.join(peaks.side(), named(group).eqNullSafe(F.col("_group")), "left").drop("_group")


def enrich(
    df: DataFrame, keys: Sequence[str], group: str, value: str, out: str = GROUP_MAX
) -> DataFrame:
    """Group maximum, surrogate key and change hash. The hash covers the group
    maximum, so a new maximum marks every row of its group as changed."""
    return with_keys(group_max(df, group, value, out), keys)
