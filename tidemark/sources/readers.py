"""Delimited files of car events and taxi rides, as tables or streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

CORRUPT = "_corrupt_record"

CAR_EVENT_SCHEMA = T.StructType(
    [
        T.StructField("event_id", T.LongType()),
        T.StructField("car_id", T.LongType()),
        T.StructField("ts", T.LongType()),  # epoch milliseconds
        T.StructField("speed", T.DoubleType()),
    ]
)

RIDE_SCHEMA = T.StructType(
    [
        T.StructField("ride_id", T.LongType()),
        T.StructField("is_start", T.BooleanType()),
        T.StructField("start_time", T.TimestampType()),
        T.StructField("end_time", T.TimestampType()),
        T.StructField("start_lon", T.DoubleType()),
        T.StructField("start_lat", T.DoubleType()),
        T.StructField("end_lon", T.DoubleType()),
        T.StructField("end_lat", T.DoubleType()),
    ]
)


def read_car_events(
    spark: SparkSession,
    path: str,
    schema: T.StructType = CAR_EVENT_SCHEMA,
    streaming: bool = False,
    **options,
) -> DataFrame:
    """Car events with ``ts`` as a timestamp; a whole-number ``ts`` is epoch milliseconds.

    ``options`` go to the csv reader or, for a stream, also to the file source
    (``maxFilesPerTrigger`` for instance). See `usable` and `rejected` for bad lines.
    """
    events = _read_lines(spark, path, schema, streaming, options)
    if isinstance(schema["ts"].dataType, T.LongType):
        events = events.withColumn("ts", F.timestamp_millis("ts"))
    return events


def read_rides(
    spark: SparkSession,
    path: str,
    schema: T.StructType = RIDE_SCHEMA,
    streaming: bool = False,
    partitions: int | None = None,
    **options,
) -> DataFrame:
    """Taxi ride records; gzip files are told by their name.

    A gzip file is read by a single task, so give ``partitions`` to spread the
    rows of a few large ones. A stream picks up where it stopped when it is
    started again with the same checkpoint location.
    """
    rides = _read_lines(spark, path, schema, streaming, options)
    return rides if partitions is None else rides.repartition(partitions)


def usable(rows: DataFrame, *times: str) -> DataFrame:
    """Well-formed rows that have all ``times``, without the bad-line column."""
    return rows.where(_is_good(times)).drop(CORRUPT)


def rejected(rows: DataFrame, *times: str) -> DataFrame:
    """The rows that `usable` leaves out."""
    return rows.where(~_is_good(times))


def _is_good(times: tuple[str, ...]):
    good = F.col(CORRUPT).isNull()
    for time in times:
        good = good & F.col(time).isNotNull()
    return good


def _read_lines(spark, path, schema, streaming, options) -> DataFrame:
    reader = spark.readStream if streaming else spark.read
    with_corrupt = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    return (
        reader.schema(with_corrupt)
        # Without pruning a line is judged by all its fields, whatever is selected.
        .options(mode="PERMISSIVE", columnNameOfCorruptRecord=CORRUPT, columnPruning=False)
        .options(**options)
        .csv(path)
    )
