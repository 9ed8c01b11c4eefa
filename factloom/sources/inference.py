"""Column types of texts, exact to the digit.

One pass over all rows, with a state per column that tasks can merge: how many values
are whole numbers, decimals, dates or truth values, and the most digits before and after
the point. A column of decimals becomes ``DECIMAL(p,s)``, never a rounded double; mixed
columns widen: whole numbers and decimals to decimals, all else to text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

WHOLE = r"^[+-]?[0-9]+$"
DECIMAL = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)$"
DATE = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$"
TIMESTAMP = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}[ T][0-9]{2}:[0-9]{2}:[0-9]{2}(\.[0-9]{1,6})?$"
TRUTH = ("true", "false")
MOST_DIGITS = 38


def _digits_before(text: Column) -> Column:
    """Digits before the point, without leading zeros."""
    return F.length(F.regexp_extract(text, r"^[+-]?0*([0-9]*)", 1))


def _digits_after(text: Column) -> Column:
    return F.length(F.regexp_extract(text, r"\.([0-9]*)$", 1))


def _leading_zero(text: Column) -> Column:
    """Codes such as 007 are not numbers."""
    return text.rlike(r"^[+-]?0[0-9]")


def state(column: Column) -> Column:
    """What a column's values have in common, as one aggregate."""
    number = column.rlike(DECIMAL) & ~_leading_zero(column)
    whole = column.rlike(WHOLE) & ~_leading_zero(column)
    date = column.rlike(DATE) & column.try_cast("date").isNotNull()
    time = column.rlike(TIMESTAMP) & column.try_cast("timestamp_ntz").isNotNull()
    return F.struct(
        F.count(column).alias("values"), F.count_if(whole).alias("whole"), F.count_if(number).alias("numbers"),
        F.count_if(date).alias("dates"), F.count_if(date | time).alias("times"), F.count_if(F.lower(column).isin(*TRUTH)).alias("truths"),
        F.coalesce(F.max(F.when(number, _digits_before(column))), F.lit(0)).alias("before"),
        F.coalesce(F.max(F.when(number, _digits_after(column))), F.lit(0)).alias("after"),
    )


def states(rows: DataFrame) -> DataFrame:
    """(column, values, whole, numbers, dates, times, truths, before, after) of every column."""
    names = rows.columns
    found = rows.agg(*[state(F.col(f"`{name}`").cast("string")).alias(f"s{i}") for i, name in enumerate(names)])
    each = F.explode(F.array(*[F.struct(F.lit(name).alias("column"), F.col(f"s{i}").alias("s")) for i, name in enumerate(names)]))
    return found.select(each.alias("e")).select("e.column", "e.s.*")


def type_of() -> Column:
    """The type of a row of ``states``, by name."""
    every = lambda name: F.col(name) == F.col("values")
    digits = F.greatest(F.lit(1), F.col("before") + F.col("after"))
    decimal = F.concat(F.lit("decimal("), digits.cast("string"), F.lit(","), F.col("after").cast("string"), F.lit(")"))
    return (
        F.when(F.col("values") == 0, "string")
        .when(every("whole") & (F.col("before") <= 9), "int")
        .when(every("whole") & (F.col("before") <= 18), "bigint")
        .when(every("numbers") & (digits <= MOST_DIGITS), decimal)
        .when(every("dates"), "date")
        .when(every("times"), "timestamp_ntz")
        .when(every("truths"), "boolean")
        .otherwise("string")
    )


def infer(rows: DataFrame) -> T.StructType:
    """The schema of a table of texts, in one pass. NULLs fit every type."""
    found = {r["column"]: r["type"] for r in states(rows).select("column", type_of().alias("type")).collect()}
    return T.StructType([T.StructField(name, T.DataType.fromDDL(found[name])) for name in rows.columns])


def convert(column: Column, kind: T.DataType) -> Column:
    """A text as a value of its column's type."""
    return column if isinstance(kind, T.StringType) else column.cast(kind)
