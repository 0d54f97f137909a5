"""Resumable annotation as a stream over a folder of files: each new record is handled once."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from alinea.sources.sinks import append_batch, exists, remaining
from alinea.workspace import materialize


def annotate_stream(spark: SparkSession, folder: str, schema: StructType, key: str, annotate: Callable[[DataFrame], DataFrame], out: str, checkpoint: str, failed: str | None = "error") -> StreamingQuery:
    """Annotate the records of all files now in ``folder`` that have no result in ``out`` yet.

    Files that an earlier run finished are known from the checkpoint, records from the results.
    Records whose ``failed`` column is set go to ``<out>-failed`` instead; each run asks for those
    again first, unless they have a result by then. A batch that is repeated after a crash replaces
    its own rows.
    """
    again = f"{out}-failed"

    def settle(fresh: DataFrame, name: str) -> None:
        done = materialize(annotate(fresh), "annotated")  # asked once for both tables
        if failed:
            append_batch(fresh.join(done.filter(f"{failed} is not null").select(key), key, "left_semi"), again, name)
            done = done.filter(f"{failed} is null")
        append_batch(done, out, name)

    def handle(batch: DataFrame, no: int) -> None:
        settle(remaining(spark, batch.dropDuplicates([key]), out, key, f"b{no}"), f"b{no}")

    if failed and exists(spark, again):
        todo = spark.read.schema(schema).parquet(again).dropDuplicates([key])
        settle(remaining(spark, todo, out, key), f"again-{uuid.uuid4().hex}")
    stream = spark.readStream.schema(schema).parquet(folder)
    return stream.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
