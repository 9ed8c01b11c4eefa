"""Landing files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from factloom.schemas import CSV_FORMAT, SRC
from factloom.sources import inference, splitting
from factloom.sources.tables import glob


def read_landing(
    spark: SparkSession,
    path: str,
    schema: T.StructType | None = SRC,
    pattern: str = "*.csv",
    file_column: str | None = None,
    multi_line: bool = True,
    mode: str = "PERMISSIVE",
    split: bool = False,
) -> DataFrame:
    """Read every CSV file in a landing folder that matches ``pattern``.

    ``schema=None`` infers the types, at the cost of one more pass. Columns are
    bound by the names in the header, whatever their order; a column the header
    lacks, or files whose headers differ, fail. ``mode`` says what a bad value
    does: NULL, or with ``FAILFAST`` an error. ``file_column`` names a column
    for the file each row came from. A quoted field may hold line breaks, hence
    one task per file; for single huge files without such fields
    ``multi_line=False`` lets Spark split them, and ``split=True`` splits files
    whose fields do hold line breaks, at the cost of one more pass over them.
    """
    if not glob(spark, f"{path}/{pattern}"):
        raise FileNotFoundError(f"no file matches {path}/{pattern}")
    if split:
        return _split(spark, path, schema, pattern, file_column, mode)
    reader = spark.read.options(**CSV_FORMAT).option("pathGlobFilter", pattern).option("mode", mode)
    if not multi_line:
        reader = reader.option("multiLine", "false")
    if schema is None:
        df = reader.option("inferSchema", "true").csv(path)
    else:
        df = reader.schema(_as_in_file(reader.csv(path).columns, schema)).option("enforceSchema", "false").csv(path)
        df = df.select(*[F.col(f"`{f.name}`") for f in schema], *([F.col("_metadata")] if file_column else []))
    if not file_column:
        return df
    return df.withColumn(file_column, F.col("_metadata.file_path")).drop("_metadata")


def _split(
    spark: SparkSession, path: str, schema: T.StructType | None, pattern: str, file_column: str | None, mode: str
) -> DataFrame:
    found = splitting.records(spark, path, pattern)
    header = spark.read.options(**CSV_FORMAT).option("pathGlobFilter", pattern).csv(path).columns
    if schema is None:
        texts = T.StructType([T.StructField(name, T.StringType()) for name in header])
        rows = splitting.parse(found, texts, mode)
        schema = inference.infer(rows.drop("file"))
        typed = [inference.convert(F.col(f"`{f.name}`"), f.dataType).alias(f.name) for f in schema]
    else:
        rows = splitting.parse(found, _as_in_file(header, schema), mode)
        typed = [F.col(f"`{f.name}`") for f in schema]
    return rows.select(*typed, *([F.col("file").alias(file_column)] if file_column else []))


def _as_in_file(header: list[str], schema: T.StructType) -> T.StructType:
    """The declared types in the order of the header; other columns are texts."""
    declared = {f.name: f for f in schema}
    missing = sorted(set(declared) - set(header))
    if missing:
        raise ValueError(f"the header lacks {missing}")
    return T.StructType([declared.get(name, T.StructField(name, T.StringType())) for name in header])
