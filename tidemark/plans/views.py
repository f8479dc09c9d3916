"""Rides, car events, trades and customers derived from the ``events`` table.

The tables hold no rides or cars, so these views read them out of the generic
events. Each view is one SQL text that Spark and DuckDB both run.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.geo import Grid

# A grid and window coarse enough for the small tables to have popular places.
COARSE_GRID = Grid(west=-74.05, north=41.0, cell_lon=0.0875, cell_lat=0.125, columns=4)
COARSE_WINDOW, COARSE_SLIDE = "24 hours", "8 hours"
COARSE_THRESHOLD = 2

_SECONDS = "(60 + cast(round(value * 100) as bigint) % 3600)"
_IS_START = "event_type in ('signup', 'view')"


def car_events_sql() -> str:
    return """
        select event_id, user_id as car_id, ts,
               case when event_type = 'error' then cast(0.0 as double) else value end as speed
        from events"""


def trades_sql() -> str:
    return """
        select event_id as trade_id, user_id as customer_id, ts, value as amount
        from events where event_type = 'purchase'"""


def customers_sql() -> str:
    return """
        select user_id as customer_id, ts, value from events where event_type = 'signup'"""


def rides_sql(seconds: str) -> str:
    """``seconds`` is a format string that makes an interval of ``{0}`` seconds."""
    duration = seconds.format(_SECONDS)
    return f"""
        select event_id as ride_id, {_IS_START} as is_start,
               case when {_IS_START} then ts else ts - {duration} end as start_time,
               case when {_IS_START} then ts + {duration} else ts end as end_time,
               (-74060000 + (event_id * 7919) % 380000) / cast(1e6 as double) as start_lon,
               (40480000 + (event_id * 104729) % 540000) / cast(1e6 as double) as start_lat,
               (-74060000 + (event_id * 15485863) % 380000) / cast(1e6 as double) as end_lon,
               (40480000 + (event_id * 32452843) % 540000) / cast(1e6 as double) as end_lat
        from events"""


SPARK_SECONDS = "make_dt_interval(0, 0, 0, {0})"
DUCKDB_SECONDS = "to_seconds({0})"


def events(spark: SparkSession, sf_dir: str, stream: bool = False) -> DataFrame:
    """The events table with a proper timestamp, as a table or as a stream of its file."""
    # Event times are stored without a zone and count as UTC.
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    path = f"{sf_dir}/events.parquet"
    if stream:
        table = _stream(spark, path)
    else:
        table = spark.read.parquet(path)
    return table.withColumn("ts", F.col("ts").cast("timestamp"))


def car_events(spark: SparkSession, sf_dir: str, stream: bool = False) -> DataFrame:
    return _view(spark, car_events_sql(), events(spark, sf_dir, stream))


def trades(spark: SparkSession, sf_dir: str, stream: bool = False) -> DataFrame:
    return _view(spark, trades_sql(), events(spark, sf_dir, stream))


def customers(spark: SparkSession, sf_dir: str, stream: bool = False) -> DataFrame:
    return _view(spark, customers_sql(), events(spark, sf_dir, stream))


def rides(spark: SparkSession, sf_dir: str, stream: bool = False) -> DataFrame:
    return _view(spark, rides_sql(SPARK_SECONDS), events(spark, sf_dir, stream))


def lines(spark: SparkSession, sf_dir: str, stream: bool = False) -> DataFrame:
    path = f"{sf_dir}/documents.parquet"
    table = _stream(spark, path) if stream else spark.read.parquet(path)
    return table.select("doc_id", "text")


def _stream(spark: SparkSession, path: str) -> DataFrame:
    # A file source takes a single file only through a pattern; folders match too.
    schema = spark.read.parquet(path).schema
    return spark.readStream.schema(schema).parquet(f"{path[:-1]}[{path[-1]}]")


def _view(spark: SparkSession, sql: str, source: DataFrame) -> DataFrame:
    return spark.sql(sql.replace("from events", "from {source}"), source=source)
