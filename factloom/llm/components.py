"""Connected components by label propagation with pointer jumping, as joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from factloom.sources.staging import Staged, stage


def components(edges: DataFrame) -> Staged:
    """(v, c) for every vertex of ``edges`` (a, b): c is the smallest vertex it reaches.

    Each round takes the smallest label among the neighbours and then the label of
    that label, so paths shorten by half. Each round's table is written to shared
    storage. Neighbours are reduced in the tasks before they are shuffled, and a
    vertex with many of them meets them in a join that can be split.
    """
    both = stage(edges.select("a", "b").union(edges.select("b", "a")).distinct(), "edges")
    labels = stage(both.df.groupBy(F.col("a").alias("v")).agg(F.least(F.min("b"), F.first("a")).alias("c")), "labels")
    while True:
        near = both.df.join(labels.side(labels.df.select(F.col("v").alias("b"), "c")), "b").groupBy(
            F.col("a").alias("v")).agg(F.min("c").alias("near"))
        best = labels.df.join(near, "v").select("v", F.col("c").alias("old"), F.least("c", "near").alias("best"))
        jump = labels.side(labels.df.select(F.col("v").alias("best"), F.col("c").alias("jump")))
        step = best.join(jump, "best", "left").select("v", F.least("best", F.coalesce("jump", "best")).alias("c"), "old")
        step = stage(step, "labels", metrics={"changed": F.count_if(F.col("c") != F.col("old"))})
        labels = Staged(step.df.drop("old"), step.rows, step.bytes, step.metrics)
        if not step.metrics["changed"]:
            return labels
