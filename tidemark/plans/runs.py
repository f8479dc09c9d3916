"""Streams run over what there is now, into tables."""

from __future__ import annotations

from collections.abc import Callable
from contextlib import nullcontext

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from tidemark.shared import scratch_dir
from tidemark.streaming.end import EndMarker
from tidemark.streaming.state import keyed_processors
from tidemark.streaming.watermark import strict_lateness


def run_appending(
    stream: DataFrame, end: EndMarker | None = None, processors: bool = True, chained: bool = False
) -> DataFrame:
    """All rows the stream appends until its input is used up.

    With ``end``, the marker that the stream was made with, also what it gives when time has
    moved past all input. Streams without stateful processors may do without their store;
    ``chained`` is for several stateful steps.
    """
    spark, scratch = stream.sparkSession, scratch_dir(stream.sparkSession)
    writer = (
        stream.writeStream.format("parquet")
        .outputMode("append")
        .option("checkpointLocation", f"{scratch}/checkpoint")
    )
    if end is None:
        writer = writer.trigger(availableNow=True)
    with nullcontext() if chained else strict_lateness(spark):
        with keyed_processors(spark) if processors else nullcontext():
            run_to_end(lambda: writer.start(f"{scratch}/rows"), spark, end)
    return spark.read.schema(stream.schema).parquet(f"{scratch}/rows")


def run_to_end(start: Callable[[], StreamingQuery], spark: SparkSession, end: EndMarker | None = None) -> None:
    """Start a query and wait until it has used up its input, and the end marker behind it."""
    query = start()
    try:
        if end is not None:
            query.processAllAvailable()
            end.write(spark)
            # A look for new files that began before the marker was there may end the first wait.
            query.processAllAvailable()
            query.processAllAvailable()
            query.stop()
        query.awaitTermination()
    finally:
        query.stop()


def run_updating(stream: DataFrame) -> DataFrame:
    """All updates the stream gives until its input is used up, with their ``batch``."""
    spark, scratch = stream.sparkSession, scratch_dir(stream.sparkSession)

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{scratch}/rows/batch={batch_id}")

    query = (
        stream.writeStream.foreachBatch(write)
        .outputMode("update")
        .option("checkpointLocation", f"{scratch}/checkpoint")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return spark.read.parquet(f"{scratch}/rows")
