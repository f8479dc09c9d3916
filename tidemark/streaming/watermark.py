"""Event-time watermarks."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.geo import ride_event_time

# Fixed value: how far out of order ride records may come.
RIDE_LAG = "5 seconds"

_CHAINED = "spark.sql.streaming.statefulOperator.allowMultiple"


def with_event_watermark(events: DataFrame, ts: str = "ts", lag_ms: int = 0) -> DataFrame:
    """Bounded out-of-orderness: the watermark trails the newest event by ``lag_ms``.

    Events without a time cannot be placed and are left out.
    """
    timed = events.where(F.col(ts).isNotNull())
    return timed.withWatermark(ts, f"{lag_ms} milliseconds")


def with_ride_watermark(rides: DataFrame, lag: str = RIDE_LAG) -> DataFrame:
    """Add the event time ``ts`` of ride records, with a watermark on it.

    Records without a time cannot be placed and are left out.
    """
    timed = rides.withColumn("ts", ride_event_time()).where(F.col("ts").isNotNull())
    return timed.withWatermark("ts", lag)


@contextmanager
def strict_lateness(spark: SparkSession) -> Iterator[None]:
    """Start queries in here to have each batch drop rows at or below its own watermark.

    By default Spark tests rows against the watermark of the batch before, because
    stateful operators may be chained. Without chaining the newer one can be used.
    """
    before = spark.conf.get(_CHAINED, "true")
    spark.conf.set(_CHAINED, "false")
    try:
        yield
    finally:
        spark.conf.set(_CHAINED, before)
