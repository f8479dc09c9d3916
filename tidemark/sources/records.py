"""Ride records as messages of a topic."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.sources.readers import CORRUPT, RIDE_SCHEMA

# Fixed value: the topic that rides are published to.
RIDE_TOPIC = "rides"

# Times are written in UTC whatever the session; fractions may be missing when read.
_CSV = {"timestampFormat": "yyyy-MM-dd HH:mm:ss[.SSSSSS]", "timeZone": "UTC"}


def rides_to_records(rides: DataFrame) -> DataFrame:
    """``key, value`` strings: the ride id and the ride as a csv line."""
    ride = F.struct(*RIDE_SCHEMA.fieldNames())
    return rides.select(
        F.col("ride_id").cast("string").alias("key"), F.to_csv(ride, _CSV).alias("value")
    )


def records_to_rides(records: DataFrame) -> DataFrame:
    """Rides out of message values; a malformed value is kept in ``_corrupt_record``.

    A message without a value holds no ride and gives no row. Use `tidemark.sources.usable` and `rejected` to part the two.
    """
    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in RIDE_SCHEMA)
    options = {**_CSV, "columnNameOfCorruptRecord": CORRUPT}
    ride = F.from_csv(F.col("value").cast("string"), f"{fields}, {CORRUPT} string", options)
    # Taken apart by inline, a value is parsed once and not for every field and filter.
    return records.where(F.col("value").isNotNull()).select(F.inline(F.array(ride)))


def write_ride_topic(
    rides: DataFrame, servers: str, topic: str = RIDE_TOPIC, checkpoint: str | None = None
):
    """Publish rides to a Kafka topic; a stream needs a ``checkpoint`` and is started."""
    options = {"kafka.bootstrap.servers": servers, "topic": topic}
    records = rides_to_records(rides)
    if not rides.isStreaming:
        return records.write.format("kafka").options(**options).save()
    sink = records.writeStream.format("kafka").options(**options)
    return sink.option("checkpointLocation", checkpoint).start()


def read_ride_topic(
    spark: SparkSession, servers: str, topic: str = RIDE_TOPIC, streaming: bool = True, **options
) -> DataFrame:
    """Rides of a Kafka topic from its earliest message on."""
    reader = spark.readStream if streaming else spark.read
    records = (
        reader.format("kafka")
        .options(subscribe=topic, startingOffsets="earliest")
        .option("kafka.bootstrap.servers", servers)
        .options(**options)
        .load()
    )
    return records_to_rides(records)
