"""CSV files with line breaks in quoted fields, read by many tasks each.

Spark splits a file at line breaks; whether a line break ends a record depends on all
quotes before it. So each byte range is read twice. First it says, for both cases,
whether a range that begins outside (or inside) a quoted field ends inside one. These
answers are composed along a file, one row per range, which tells where each range
truly begins. Then every range gives its records. What is cut by a range's edge goes
out in fragments, which are put together by the range the record began in; there is
at most one such record per range.

Quotes count as the reader's rules have it: one at the start of a field opens it, two in
a row stand for one, and those in the middle of a plain field are text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from factloom.schemas import CSV_FORMAT
from factloom.sources.staging import Staged, stage

QUOTE, COMMA = '"', ","
TASK_BYTES, TASKS = 32 << 20, 4


def ends_inside(line: str, inside: bool) -> bool:
    """Whether a quoted field is open at the end of a line."""
    at = 0
    while True:
        if inside or line.startswith(QUOTE, at):
            at += not inside
            while True:
                at = line.find(QUOTE, at)
                if at < 0:
                    return True
                if not line.startswith(QUOTE, at + 1):
                    break
                at += 2
            inside = False
        at = line.find(COMMA, at)
        if at < 0:
            return False
        at += 1


def _lines(spark: SparkSession, path: str, pattern: str) -> DataFrame:
    """The physical lines of all files with the file and byte range they come from, in order.
    A task reads many ranges one after the other: what tasks report to the driver does not
    grow with the number of ranges."""
    lines = spark.read.option("lineSep", "\n").option("pathGlobFilter", pattern).text(path)
    return _few_tasks(lines.select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"),
                                   F.monotonically_increasing_id().alias("line")), path)


def _few_tasks(df: DataFrame, path: str) -> DataFrame:
    """Tasks of ``TASK_BYTES`` of the files at ``path``, and ``TASKS`` per core at least."""
    spark = df.sparkSession
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    size = folder.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(folder).getLength()
    return df.coalesce(max(TASKS * spark.sparkContext.defaultParallelism, -(-size // TASK_BYTES)))


def _runs(batch: pa.RecordBatch) -> Iterator[tuple[tuple[str, int], pa.RecordBatch]]:
    """The stretches of a batch that come from one range."""
    files, starts = batch["file"].dictionary_encode(), batch["start"].to_numpy()
    codes = files.indices.to_numpy(zero_copy_only=False)
    new = np.flatnonzero((codes[1:] != codes[:-1]) | (starts[1:] != starts[:-1])) + 1
    for low, high in zip([0, *new.tolist()], [*new.tolist(), batch.num_rows]):
        if low < high:
            yield (files.dictionary[codes[low]].as_py(), int(starts[low])), batch.slice(low, high - low)


def _quoted(batch: pa.RecordBatch) -> list[int]:
    """Which lines hold a quote at all; no other changes anything."""
    return np.flatnonzero(pc.match_substring(batch["value"], QUOTE).to_numpy(zero_copy_only=False)).tolist()


def _answers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per range: how it ends if it begins outside, or inside, and whether in the
    latter case some line of it ends outside."""
    now, state = None, (False, True, False)

    def row() -> pa.RecordBatch:
        return pa.RecordBatch.from_pylist([{"file": now[0], "start": now[1], "outside": state[0], "inside": state[1], "closes": state[2]}])

    for batch in batches:
        for place, part in _runs(batch):
            if place != now:
                if now is not None:
                    yield row()
                now, state = place, (False, True, False)
            for i in _quoted(part):
                line = part["value"][i].as_py()
                outside, inside = ends_inside(line, state[0]), ends_inside(line, state[1])
                state = outside, inside, state[2] or not inside
    if now is not None:
        yield row()


def ranges(lines: DataFrame) -> Staged:
    """(file, start, begins, owner, plain, first): whether each range begins inside a field, the
    range in which the record that it then goes on with began, whether its file has no quotes
    at all, and its first line."""
    # Only lines with a quote change anything; a range without one goes on as it began.
    quoted = lines.where(F.col("value").contains(QUOTE)).select("value", "file", "start")
    places = stage(lines.groupBy("file", "start").agg(F.min("line").alias("first")), "range-places").df
    found = stage(quoted.mapInArrow(
        _answers, "file string, start long, outside boolean, inside boolean, closes boolean"), "range-answers").df
    same = {"outside": False, "inside": True, "closes": False}
    changed = found.withColumn("quoted", F.lit(1))
    answers = places.join(changed, ["file", "start"], "left").fillna(same | {"quoted": 0})
    # One row per byte range; a file of terabytes has some ten thousand.
    along = Window.partitionBy("file").orderBy("start")
    before = along.rowsBetween(Window.unboundedPreceding, -1)
    turned = F.sum(F.when(F.col("outside") & ~F.col("inside"), 1).otherwise(0))
    fixed = F.when(F.col("outside") == F.col("inside"), F.struct("outside", "turns"))
    known = answers.withColumn("turns", turned.over(along)).withColumns({
        "last": F.last(fixed, ignorenulls=True).over(before), "turned": F.coalesce(F.lag("turns").over(along), F.lit(0))})
    odd = (F.col("turned") - F.coalesce("last.turns", F.lit(0))) % 2 == 1
    known = known.withColumn("begins", F.coalesce("last.outside", F.lit(False)) != odd)
    starts_record = F.when(~F.col("begins") | F.col("closes"), F.col("start"))
    within = Window.partitionBy("file")
    return stage(known.select(
        "file", "start", "begins", F.last(starts_record, ignorenulls=True).over(before).alias("owner"),
        (F.max("quoted").over(within) == 0).alias("plain"), "first"), "ranges")


_PARTS = pa.schema([("file", pa.string()), ("start", pa.int64()), ("owner", pa.int64()), ("header", pa.bool_()), ("text", pa.string())])


def _records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Whole records (owner NULL), and the fragments of those that a range's edge cuts."""
    now, owner, inside, first, held = None, None, False, False, []

    def part(text: str, whose: int | None) -> pa.RecordBatch:
        return pa.RecordBatch.from_pylist(
            [{"file": now[0], "start": now[1], "owner": whose, "header": first, "text": text}], schema=_PARTS)

    def whole(texts: pa.Array) -> pa.RecordBatch:
        n = len(texts)
        header = np.zeros(n, bool)
        header[0] = first
        return pa.RecordBatch.from_arrays(
            [pa.array([now[0]]).take(pa.array(np.zeros(n, int))), pa.array(np.full(n, now[1])), pa.nulls(n, pa.int64()),
             pa.array(header), texts.cast(pa.string())], schema=_PARTS)

    def rest() -> Iterator[pa.RecordBatch]:
        if held:
            yield part("\n".join(held), now[1] if owner is None else owner)

    for batch in batches:
        for place, lines in _runs(batch):
            if place != now:
                yield from rest()
                now, held = place, []
                inside = lines["begins"][0].as_py()
                owner = lines["owner"][0].as_py() if inside else None
                first = place[1] == 0
            texts, at = lines["value"], 0
            for i in [*_quoted(lines), len(texts)]:
                plain = texts.slice(at, i - at)
                if inside:
                    held += plain.to_pylist()
                elif len(plain):
                    yield whole(plain)
                    first = False
                if i == len(texts):
                    break
                line = texts[i].as_py()
                held.append(line)
                inside, at = ends_inside(line, inside), i + 1
                if not inside:
                    if owner is None:
                        yield whole(pa.array(["\n".join(held)]))
                        first = False
                    else:  # the end of a record of an earlier range
                        yield part("\n".join(held), owner)
                    owner, held = None, []
    yield from rest()


def records(spark: SparkSession, path: str, pattern: str = "*.csv") -> DataFrame:
    """(file, header, text): every record of the files as text, with the line breaks in its
    fields. ``header`` marks the first of a file. Blank lines are left out."""
    lines = _lines(spark, path, pattern)
    known = ranges(lines)
    kinds = known.df.agg(F.bool_or("plain").alias("plain"), F.bool_or(~F.col("plain")).alias("quoted")).first()
    every = None
    if kinds.plain or not kinds.quoted:
        # A line of a file without quotes is a record: Python has nothing to do there.
        plain = known.side(known.df.where("plain AND start = 0").select("file", "first"))
        whole = lines.join(plain, "file").select("file", (F.col("line") == F.col("first")).alias("header"), F.col("value").alias("text"))
        every = _few_tasks(stage(whole, "plain-records").df, path)
    if kinds.quoted:
        cut = _quoted_records(lines, known, path)
        every = cut if every is None else every.unionByName(cut)
    return every.withColumn("text", F.regexp_replace("text", r"\r\z", "")).where("text <> ''")


def _quoted_records(lines: DataFrame, known: Staged, path: str) -> DataFrame:
    """The records of the files that hold quotes."""
    places = known.side(known.df.where("NOT plain").select("file", "start", "begins", "owner"))
    joined = lines.join(places, ["file", "start"])
    if not known.small:  # the join was shuffled
        joined = joined.repartition("file", "start").sortWithinPartitions("file", "start", "line")
    parts = _few_tasks(stage(joined.select("file", "start", "value", "begins", "owner").mapInArrow(
        _records, "file string, start long, owner long, header boolean, text string"), "records").df, path)
    cut = parts.where("owner IS NOT NULL").groupBy("file", "owner").agg(
        F.max("header").alias("header"), F.sort_array(F.collect_list(F.struct("start", "text"))).alias("p"))
    cut = cut.select("file", "header", F.concat_ws("\n", "p.text").alias("text"))
    return parts.where("owner IS NULL").select("file", "header", "text").unionByName(cut)


def parse(found: DataFrame, in_file: T.StructType, mode: str) -> DataFrame:
    """The columns of the records, with ``file``. A file whose header differs fails."""
    options = {k: v for k, v in CSV_FORMAT.items() if k != "header"} | {"mode": mode}
    names = F.from_csv("text", F.lit(", ".join(f"c{i} string" for i in range(len(in_file)))), options)
    expected = [f.name for f in in_file]
    other = found.where("header").select("file", F.array(*[names[f"c{i}"] for i in range(len(in_file))]).alias("names"))
    other = other.where(F.to_json("names") != F.to_json(F.array(*map(F.lit, expected)))).limit(1).collect()
    if other:
        raise ValueError(f"the header of {other[0]['file']} is {other[0]['names']}, not {expected}")
    row = F.from_csv("text", F.lit(_ddl(in_file)), options)
    return found.where("NOT header").select("file", row.alias("row")).select("file", "row.*")


def _ddl(schema: T.StructType) -> str:
    return ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in schema)
