"""Parquet tables that can be overwritten and merged while they are read.

Spark cannot overwrite a Parquet folder it is reading, nor run MERGE on one.
So a table is a folder of snapshots, each written by one ordinary partitioned
write and complete once Spark's ``_SUCCESS`` marker is there:

    <table>/snapshot=000001-base-64/key_bucket=0/part-...   the whole table
    <table>/snapshot=000002-delta-64/key_bucket=7/part-...  whole rewritten buckets
    <table>/snapshot=000003-append-64/key_bucket=5/part-... further rows

The current content of a bucket is its copy in the latest complete base or delta,
and what was appended since. Rows are bucketed by their surrogate key, so a merge
rewrites only the buckets in which a row changed. One writer at a time.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

BUCKET = "key_bucket"
DEFAULT_BUCKETS = 64
OPEN_FILES = 64


def glob(spark: SparkSession, pattern: str) -> list[str]:
    """Paths on any Hadoop file system that match ``pattern``."""
    path = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    found = path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(path)
    return sorted(status.getPath().toString() for status in found or [])


def create_namespaces(spark: SparkSession, names: Iterable[str]) -> None:
    for name in names:
        spark.sql(f"CREATE SCHEMA IF NOT EXISTS `{name}`")


def create_or_replace(spark: SparkSession, path: str, schema: T.StructType, buckets: int = DEFAULT_BUCKETS) -> None:
    """Make ``path`` an empty table with the given columns."""
    spark.createDataFrame([], schema).write.parquet(_next_snapshot(spark, path, "base", buckets))


def overwrite(df: DataFrame, path: str, key: str, buckets: int = DEFAULT_BUCKETS) -> int:
    """Make ``df`` the whole content of the table; return its row count. Choose
    the number of buckets so that one is a few gigabytes."""
    target = _next_snapshot(df.sparkSession, path, "base", buckets)
    rows = _write_buckets(gathered(df, key, buckets), target)
    if not rows:
        # A partitioned write of no rows leaves no file that tells the columns.
        create_or_replace(df.sparkSession, path, df.schema, buckets)
    return rows


def append(df: DataFrame, path: str, key: str) -> int:
    """Add rows and leave all others as they lie; return how many were added."""
    spark = df.sparkSession
    buckets = bucket_count(spark, path)
    return _write_buckets(gathered(df, key, buckets), _next_snapshot(spark, path, "append", buckets))


def replace_buckets(
    kept: DataFrame, new: DataFrame, path: str, key: str, in_place: bool = False
) -> int:
    """Replace the buckets that occur in the rows by the rows; return how many
    there are. ``in_place`` says that the kept rows come in the order in which
    the table stores them, and need no shuffle to be gathered by bucket."""
    spark = kept.sparkSession
    buckets = bucket_count(spark, path)
    target = _next_snapshot(spark, path, "delta", buckets)
    if in_place:
        return _write_buckets(with_bucket(kept, key, buckets).unionByName(gathered(new, key, buckets)), target)
    return _write_buckets(gathered(kept.unionByName(new), key, buckets), target)


def replace_in_rounds(spark: SparkSession, path: str, rounds: Sequence[DataFrame]) -> int:
    """Replace the buckets that occur in the rows by the rows; return how many there are. The
    rows name their bucket and lie by it. Each frame is a job of its own; all belong to one
    snapshot, which the last of them completes."""
    target = _next_snapshot(spark, path, "delta", bucket_count(spark, path))
    return sum(_write_buckets(rows, target, last=i == len(rounds)) for i, rows in enumerate(rounds, 1))


def read_current(spark: SparkSession, path: str, only: Iterable[int] | None = None) -> DataFrame:
    """The current content of the table, or of the buckets in ``only``."""
    base, live = _live_buckets(spark, path)
    wanted = list(live) if only is None else [b for b in only if b in live]
    if not wanted:
        # An empty selection still has the columns of the table.
        some = next(iter(live.values()), [base])[0]
        return spark.read.parquet(some).limit(0)
    rows = spark.read.option("basePath", path).parquet(*[folder for b in wanted for folder in live[b]])
    return rows.drop("snapshot", BUCKET)


def footer_counts(spark: SparkSession, path: str) -> DataFrame:
    """``(snapshot, key_bucket, rows)`` of the current content, counted from the footers
    of its files: no column is read. The frame belongs to a session of its own, as the
    reader that pushes counts to the footers is chosen by settings."""
    apart = spark.newSession()
    v1 = apart.conf.get("spark.sql.sources.useV1SourceList").split(",")
    apart.conf.set("spark.sql.sources.useV1SourceList", ",".join(s for s in v1 if s.strip() != "parquet"))
    apart.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    _, live = _live_buckets(spark, path)
    folders = [folder for bucket in live.values() for folder in bucket]
    if not folders:
        return apart.createDataFrame([], f"snapshot string, {BUCKET} int, rows long")
    rows = apart.read.option("basePath", path).parquet(*folders)
    # A count is pushed down if it is grouped by all partition columns.
    return rows.groupBy("snapshot", BUCKET).agg(F.count(F.lit(1)).alias("rows"))


def stored_row_counts(spark: SparkSession, paths: Mapping[str, str]) -> dict[str, dict[int, int]]:
    """Rows of each named table by bucket, from footers alone. What comes to the driver
    is a number per bucket and snapshot."""
    counts: dict[str, dict[int, int]] = {}
    for name, path in paths.items():
        found = counts[name] = {}
        for row in footer_counts(spark, path).collect():
            found[row[BUCKET]] = found.get(row[BUCKET], 0) + row.rows
    return counts


def drop_superseded(spark: SparkSession, path: str) -> int:
    """Delete the snapshots before the last complete base, once nobody reads
    them any more; return how many there were."""
    base, _ = _live_buckets(spark, path)
    old = [s for s in glob(spark, f"{path}/snapshot=*") if s < base]
    for snapshot in old:
        folder = spark._jvm.org.apache.hadoop.fs.Path(snapshot)
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
    return len(old)


def exists(spark: SparkSession, path: str) -> bool:
    return bool(_complete_snapshots(spark, path))


def bucket_count(spark: SparkSession, path: str) -> int:
    return int(_complete_snapshots(spark, path)[-1].rsplit("-", 1)[1])


def bucket_of(key: str, buckets: int):
    return F.pmod(F.col(key), F.lit(buckets)).cast("int")


def with_bucket(df: DataFrame, key: str, buckets: int) -> DataFrame:
    return df.withColumn(BUCKET, bucket_of(key, buckets))


def in_ranges(df: DataFrame, key: str, buckets: int) -> DataFrame:
    """The rows with their bucket, in ranges of bucket and key: rows of one key are in one
    task, and a task has few buckets to write."""
    return with_bucket(df, key, buckets).repartitionByRange(BUCKET, key)


def gathered(df: DataFrame, key: str, buckets: int) -> DataFrame:
    """The rows of a bucket in as few tasks as their size allows: a rebalance
    splits what is too large for one task."""
    return with_bucket(df, key, buckets).hint("rebalance", F.col(BUCKET))


def _write_buckets(df: DataFrame, target: str, last: bool = True) -> int:
    """Write by bucket; count the rows in the same pass. Up to ``OPEN_FILES`` buckets are
    written side by side: sorting them would hold all rows of a task, and vectors that take
    little room in a shuffle take gigabytes in memory. Only the ``last`` write to a snapshot
    marks it complete."""
    spark, name, seen = df.sparkSession, "spark.sql.maxConcurrentOutputFileWriters", Observation()
    counted = df.observe(seen, F.count(F.lit(1)).alias("rows"))
    before = spark.conf.get(name)
    spark.conf.set(name, str(OPEN_FILES))
    try:
        writer = counted.write.mode("append").option("mapreduce.fileoutputcommitter.marksuccessfuljobs", str(last).lower())
        writer.partitionBy(BUCKET).parquet(target)
    finally:
        spark.conf.set(name, before)
    return seen.get["rows"]


def _complete_snapshots(spark: SparkSession, path: str) -> list[str]:
    return [done.rsplit("/", 1)[0] for done in glob(spark, f"{path}/snapshot=*/_SUCCESS")]


def _next_snapshot(spark: SparkSession, path: str, kind: str, buckets: int) -> str:
    # Unfinished snapshots count too: their names are never used again.
    taken = [int(s.rsplit("=", 1)[1].split("-")[0]) for s in glob(spark, f"{path}/snapshot=*")]
    return f"{path}/snapshot={max(taken, default=0) + 1:06d}-{kind}-{buckets}"


def _live_buckets(spark: SparkSession, path: str) -> tuple[str, dict[int, list[str]]]:
    snapshots = _complete_snapshots(spark, path)
    bases = [s for s in snapshots if s.rsplit("-", 2)[1] == "base"]
    if not bases:
        raise FileNotFoundError(f"no table at {path}")
    live: dict[int, list[str]] = {}
    for snapshot in snapshots[snapshots.index(bases[-1]) :]:
        kind = snapshot.rsplit("-", 2)[1]
        for folder in glob(spark, f"{snapshot}/{BUCKET}=*"):
            bucket = int(folder.rsplit("=", 1)[1])
            older = live.get(bucket, []) if kind == "append" else []
            live[bucket] = [*older, folder]
    return bases[-1], live
