"""Sharding along a Hilbert curve, with DataFrame functions only.

Several metadata columns are quantised to a few bits each, numbers by quantiles of
the whole table and labels by hash, and combined to the index of their cell on a
Hilbert curve. Rows are sorted by that index and the sorted sequence is cut into
runs, so that each shard covers few cells of every dimension and files can be
skipped by any of them. Rows of one cell are ordered by checksum and id, so a hot
cell is spread over as many tasks and shards as its rows need.

Defined cases: NULL numbers lie in the lowest level, NULL labels hash as empty
ones, and a NULL text has 8 bytes and the checksum 0. Equal rows stay side by
side. An empty table gives no rows. Fewer rows than shards leave shards empty.
Extra columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from factloom.sources.staging import stage


def hilbert_index(levels: list[Column], bits: int, df: DataFrame, name: str) -> DataFrame:
    """Adds the curve index of integer ``levels`` below 2**bits.

    The transform of axes to a transposed index: per bit from the top, swap or
    invert the lower bits of the first axis; then Gray-encode and interleave.
    Every step is a projection of integers.
    """
    n = len(levels)
    axes = [f"_axis{i}" for i in range(n)]
    df = df.withColumns({axis: level.cast("int") for axis, level in zip(axes, levels)})
    x0 = F.col(axes[0])
    for bit in range(bits - 1, 0, -1):
        low = (1 << bit) - 1
        for axis in axes:
            x = F.col(axis)
            is_set = x.bitwiseAND(1 << bit) != 0
            swap = x0.bitwiseXOR(x).bitwiseAND(low)
            first = F.when(is_set, x0.bitwiseXOR(F.lit(low))).otherwise(x0.bitwiseXOR(swap))
            if axis == axes[0]:
                df = df.withColumn(axis, F.when(is_set, x0.bitwiseXOR(F.lit(low))).otherwise(x0))
            else:
                df = df.withColumns({axes[0]: first, axis: F.when(is_set, x).otherwise(x.bitwiseXOR(swap))})
    for before, axis in zip(axes, axes[1:]):
        df = df.withColumn(axis, F.col(axis).bitwiseXOR(F.col(before)))
    last, turn = F.col(axes[-1]), F.lit(0)
    for bit in range(bits - 1, 0, -1):
        turn = F.when(last.bitwiseAND(1 << bit) != 0, turn.bitwiseXOR(F.lit((1 << bit) - 1))).otherwise(turn)
    df = df.withColumn("_turn", turn)
    index = F.lit(0).cast("long")
    for bit in range(bits - 1, -1, -1):
        for axis in axes:
            one = F.shiftright(F.col(axis).bitwiseXOR(F.col("_turn")), bit).bitwiseAND(1)
            index = F.shiftleft(index, 1) + one.cast("long")
    return df.withColumn(name, index).drop("_turn", *axes)


def quantised(df: DataFrame, numbers: list[str], labels: list[str], bits: int) -> list[Column]:
    """Levels 0 to 2**bits - 1 for each column. Bounds of numbers are quantiles of all
    rows; there are as many as levels, whatever the table's size."""
    steps = 1 << bits
    shares = [i / steps for i in range(1, steps)]
    got = df.agg(*[F.percentile_approx(F.col(c).cast("double"), shares, 10_000).alias(c) for c in numbers]).first()
    levels = []
    for name in numbers:
        value = F.coalesce(F.col(name).cast("double"), F.lit(float("-inf")))
        level = F.lit(0)
        for bound in sorted(set(got[name] or [])):
            level = level + (value > F.lit(float(bound))).cast("int")
        levels.append(level)
    for name in labels:
        levels.append(F.pmod(F.crc32(F.coalesce(F.col(name), F.lit("")).cast("binary")), F.lit(steps)))
    return levels


def shard(docs: DataFrame, shards: int = 24, bits: int = 4) -> DataFrame:
    """doc_id, size, text_crc32, curve, shard and slot of every document.

    Row counts of shards differ by one at most. Only these numbers are sorted and
    shuffled, not the texts.
    """
    text = F.col("text").cast("string")
    base = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 8).alias("size"),
        F.crc32(F.coalesce(text, F.lit("")).cast("binary")).alias("text_crc32"),
        F.col("lang").cast("string").alias("lang"), F.col("source").cast("string").alias("source"),
    )
    base = stage(base, "shard-metadata").df
    placed = hilbert_index(quantised(base, ["size"], ["source", "lang"], bits), bits, base, "curve")
    order = ["curve", "text_crc32", "doc_id"]
    ranged = (placed.select("doc_id", "size", "text_crc32", "curve").repartitionByRange(*order)
              .sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id()))
    rows = stage(ranged, "shard-order")
    # One row per task: how many rows lie in the tasks before it.
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    part = F.shiftright("_at", 33)
    starts = rows.df.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n")).select(
        "_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    rank = F.col("_start") + F.col("_at").bitwiseAND((1 << 33) - 1)
    total = max(rows.rows, 1)
    ranked = rows.df.withColumn("_part", part).join(F.broadcast(starts), "_part").withColumn("_rank", rank)
    number = F.expr(f"_rank * {shards}L div {total}L")
    first = F.expr(f"({total}L * _shard + {shards - 1}L) div {shards}L")
    return ranked.withColumn("_shard", number).select(
        "doc_id", "size", "text_crc32", "curve",
        F.col("_shard").cast("int").alias("shard"), (F.col("_rank") - first).alias("slot"),
    )


def write_shards(docs: DataFrame, plan: DataFrame, path: str) -> None:
    """The documents as one folder per shard. Each shard's rows are dealt to several
    tasks, each of which sorts its own."""
    text = F.crc32(F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary"))
    where = plan.select(F.col("doc_id").alias("_doc"), F.col("text_crc32").alias("_crc"), "shard", "slot").dropDuplicates(["_doc", "_crc"])
    joined = docs.withColumn("_key", text).join(where, F.col("doc_id").eqNullSafe(F.col("_doc")) & (F.col("_key") == F.col("_crc")))
    (joined.drop("_key", "_doc", "_crc").repartition("shard", F.pmod("slot", F.lit(16)))
     .sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path))
