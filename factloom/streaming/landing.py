"""The delta load, fed by new landing files as they arrive."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery

from factloom.operators.merge import MergeResult
from factloom.plans.loads import LoadSpec, delta_load
from factloom.schemas import CSV_FORMAT


def merge_new_files(
    spark: SparkSession,
    landing: str,
    table: str,
    checkpoint: str,
    spec: LoadSpec = LoadSpec(),
    dedupe_by: str | None = None,
    on_merge: Callable[[int, MergeResult], None] | None = None,
) -> StreamingQuery:
    """Merge all files that arrived since the last run, then stop. A batch that
    is replayed after a failure changes nothing, by the change hashes."""

    def merge(batch, batch_id: int) -> None:
        result = delta_load(batch, table, spec, dedupe_by)
        if on_merge is not None:
            on_merge(batch_id, result)

    # A file whose header differs from the schema stops the stream.
    reader = spark.readStream.schema(spec.schema).options(**CSV_FORMAT).option("enforceSchema", "false")
    reader = reader.option("pathGlobFilter", spec.pattern).option("mode", spec.mode)
    files = (reader if spec.multi_line else reader.option("multiLine", "false")).csv(landing)
    return (
        files.writeStream.foreachBatch(merge)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
