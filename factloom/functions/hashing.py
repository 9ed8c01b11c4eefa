"""Surrogate keys and change hashes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from factloom.schemas import ROW_HASH, ROW_KEY


def named(name: str) -> Column:
    """The column of that very name, whatever characters it holds."""
    return F.col(quoted(name))


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def row_hash(columns: Sequence[str]) -> Column:
    """64-bit hash of the columns. Spark's hash skips NULLs, so each value is
    preceded by its null flag: (a, NULL) and (NULL, a) differ."""
    flagged = [part for c in columns for part in (F.isnull(named(c)), named(c).cast("string"))]
    return F.xxhash64(*flagged)


def portable_hash(columns: Sequence[Column]) -> Column:
    """Hash that other engines can reproduce: md5 over ``|``-joined texts, NULL
    as ``~``. In texts a backslash goes before these two and before itself, so that
    different rows have different texts."""
    plain = [F.regexp_replace(c.cast("string"), r"([\\|~])", r"\\$1") for c in columns]
    return F.md5(F.concat_ws("|", *[F.coalesce(c, F.lit("~")) for c in plain]))


def with_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Add ``row_sk`` over the natural key and ``row_hash`` over all the other
    columns, in schema order."""
    payload = [c for c in df.columns if c not in (*keys, ROW_KEY, ROW_HASH)]
    return df.withColumns({ROW_KEY: row_hash(keys), ROW_HASH: row_hash(payload)})


def same_key(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> Column:
    """Join condition on the natural key in which NULL equals NULL."""
    condition = F.lit(True)
    for key in keys:
        condition = condition & left[quoted(key)].eqNullSafe(right[quoted(key)])
    return condition
