"""Intermediate tables on shared storage.

Staging a DataFrame writes it once under the folder the cluster names in
``spark.checkpoint.dir`` and reads it back. That cuts the lineage in a way that
survives the loss of an executor, and it yields the exact row count and data
size, on which broadcast decisions rest.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# A side is broadcast only if it was measured to be at most this large.
BROADCAST_BYTES = 64 << 20
BROADCAST_ROWS = 2_000_000

_WIDTH = {T.ByteType: 1, T.ShortType: 2, T.IntegerType: 4, T.FloatType: 4}


@dataclass(frozen=True)
class Staged:
    df: DataFrame
    rows: int
    bytes: int
    metrics: dict

    @property
    def small(self) -> bool:
        return self.bytes <= BROADCAST_BYTES and self.rows <= BROADCAST_ROWS

    def side(self, df: DataFrame | None = None) -> DataFrame:
        """This table, or a narrower ``df`` made from it, as one side of a join:
        broadcast if measured small, otherwise left to the optimizer."""
        df = self.df if df is None else df
        return F.broadcast(df) if self.small else df


def scratch_root(spark: SparkSession) -> str:
    """The shared scratch folder of this application."""
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        shared = tempfile.mkdtemp(prefix="factloom-")
        spark.sparkContext.setCheckpointDir(shared)
    return f"{shared.rstrip('/')}/factloom/{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path in the scratch folder."""
    return f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex}"


def clear_scratch(spark: SparkSession) -> None:
    """Delete what this application has staged, once its results are written."""
    root = spark._jvm.org.apache.hadoop.fs.Path(scratch_root(spark))
    root.getFileSystem(spark._jsc.hadoopConfiguration()).delete(root, True)


def stage(df: DataFrame, label: str, metrics: dict[str, Column] | None = None, **options: str) -> Staged:
    """Write ``df`` to scratch storage and return it with its measured size.

    ``metrics`` are further aggregates to take in the same pass. They are
    observed in the writing stage itself, so a retried task counts once.
    ``options`` go to the writer.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    seen = Observation()
    observed = df.observe(
        seen,
        F.count(F.lit(1)).alias("rows"),
        F.coalesce(F.sum(_row_bytes(df.schema)), F.lit(0)).alias("bytes"),
        *[expr.alias(name) for name, expr in (metrics or {}).items()],
    )
    observed.write.options(**options).parquet(path)
    got = dict(seen.get)
    return Staged(
        df=spark.read.schema(df.schema).parquet(path),
        rows=got.pop("rows"),
        bytes=got.pop("bytes"),
        metrics=got,
    )


@contextmanager
def arrow_batches(spark: SparkSession, most_bytes: int) -> Iterator[None]:
    """Inside, jobs hand rows to Python in batches that end at so many bytes."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(most_bytes))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def _row_bytes(schema: T.StructType) -> Column:
    """Approximate in-memory size of a row."""
    return reduce(add, [_field_bytes(f) for f in schema.fields], F.lit(0).cast("long"))


def _field_bytes(field: T.StructField) -> Column:
    value = F.col(f"`{field.name}`")
    kind = field.dataType
    if isinstance(kind, (T.StringType, T.BinaryType)):
        size = F.octet_length(value)
    elif isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.NumericType):
        size = F.size(value) * _WIDTH.get(type(kind.elementType), 8)
    elif isinstance(kind, (T.ArrayType, T.MapType, T.StructType)):
        size = F.octet_length(F.to_json(F.struct(value)))
    else:
        return F.lit(16)
    return F.coalesce(size, F.lit(0)).cast("long") + 16
