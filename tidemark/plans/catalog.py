"""The registered queries: every operator over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import operators, sources, streaming
from tidemark.functions.geo import grid_cell_center, ride_event_time, travel_features
from tidemark.plans import oracle, views
from tidemark.plans.runs import run_appending, run_to_end, run_updating
from tidemark.shared import scratch_dir
from tidemark.streaming import EndMarker

PLACES = {
    "grid": views.COARSE_GRID,
    "window": views.COARSE_WINDOW,
    "slide": views.COARSE_SLIDE,
    "threshold": views.COARSE_THRESHOLD,
}
CAR_GAP = "6 hours"
LAG = "5 seconds"
# The events of a car are hours apart.
STRETCH, PIECE = "7 days", "7 days"

Query = Callable[[SparkSession, str], DataFrame]


def word_count(spark, sf_dir):
    return operators.word_count(views.lines(spark, sf_dir))


def word_count_stream(spark, sf_dir):
    updates = run_updating(operators.word_count(views.lines(spark, sf_dir, stream=True)))
    return updates.groupBy("word").agg(F.max_by("cnt", "batch").alias("cnt"))


def word_running_count(spark, sf_dir):
    return operators.word_running_count(views.lines(spark, sf_dir), ["doc_id"])


def rides_in_bbox(spark, sf_dir):
    return operators.rides_in_bbox(views.rides(spark, sf_dir))


def rides_in_bbox_stream(spark, sf_dir):
    rides = streaming.with_ride_watermark(views.rides(spark, sf_dir, stream=True))
    return run_appending(operators.rides_in_bbox(rides, event_time="ts").drop("ts"), processors=False)


def grid_cells(spark, sf_dir):
    inside = operators.rides_in_bbox(views.rides(spark, sf_dir))
    cells = operators.ride_cells(inside, views.COARSE_GRID)
    lon, lat = grid_cell_center(F.col("cell"), views.COARSE_GRID)
    return cells.select("ride_id", "ts", "cell", lon.alias("lon"), lat.alias("lat"))


def popular_places(spark, sf_dir):
    return operators.popular_places(views.rides(spark, sf_dir), **PLACES)


def popular_places_stream(spark, sf_dir):
    rides, end = _ended(spark, _timed(views.rides(spark, sf_dir, stream=True)))
    return run_appending(operators.popular_places(rides, **PLACES), end, processors=False)


def popular_places_panes_stream(spark, sf_dir):
    rides, end = _ended(spark, _timed(views.rides(spark, sf_dir, stream=True)))
    places = operators.popular_places(rides, by_panes=True, **PLACES)
    return run_appending(places, end, processors=False, chained=True)


def place_documents(spark, sf_dir):
    return sources.place_documents(popular_places(spark, sf_dir))


def gap_segments(spark, sf_dir):
    return _rounded(operators.gap_segments(views.car_events(spark, sf_dir), ["car_id"], CAR_GAP))


def gap_segments_stream(spark, sf_dir):
    events, end = _ended(spark, views.car_events(spark, sf_dir, stream=True))
    segments = operators.gap_segments(events, ["car_id"], CAR_GAP)
    return _rounded(run_appending(segments, end, processors=False))


def stop_segments_by_car(spark, sf_dir):
    return _rounded(operators.stop_segments(views.car_events(spark, sf_dir), ["car_id"]))


def stop_segments_global(spark, sf_dir):
    return _rounded(operators.stop_segments(views.car_events(spark, sf_dir)))


def stop_segments_stream(spark, sf_dir):
    events, end = _ended(spark, views.car_events(spark, sf_dir, stream=True))
    segments = streaming.stop_segments_stream(events, ["car_id"], stretch=STRETCH)
    return _rounded(run_appending(segments, end))


def stop_segments_global_stream(spark, sf_dir):
    events, end = _ended(spark, views.car_events(spark, sf_dir, stream=True))
    segments = streaming.stop_segments_stream(events, piece=PIECE)
    return _rounded(run_appending(segments, end, chained=True))


def event_time_sort(spark, sf_dir):
    return operators.event_time_position(views.car_events(spark, sf_dir), ["car_id"])


def event_time_sort_stream(spark, sf_dir):
    events, end = _ended(spark, views.car_events(spark, sf_dir, stream=True))
    return run_appending(streaming.event_time_sort_stream(events, ["car_id"]), end, processors=False)


def late_rows(spark, sf_dir):
    arrival = F.col("event_id") + (F.col("event_id") * 7919) % 3000
    events = views.car_events(spark, sf_dir).withColumn("arrival", arrival)
    late = operators.late_rows(events, ["car_id"], ("arrival", "event_id"), "12 hours")
    return late.select("event_id", "car_id", "ts", "arrival", "watermark")


def event_time_join(spark, sf_dir):
    joined = operators.event_time_join(
        views.trades(spark, sf_dir), views.customers(spark, sf_dir)
    )
    return _enriched(joined)


def event_time_join_small(spark, sf_dir):
    joined = operators.event_time_join(
        views.trades(spark, sf_dir), views.customers(spark, sf_dir), small_bytes=64_000_000
    )
    return _enriched(joined)


def committed_places(spark, sf_dir):
    """Popular places of a stream as documents, by way of the sink that commits batches."""
    rides, end = _ended(spark, _timed(views.rides(spark, sf_dir, stream=True)))
    documents = sources.place_documents(operators.popular_places(rides, **PLACES))
    path, checkpoint = (f"{scratch_dir(spark)}/{name}" for name in ("documents", "checkpoint"))
    run_to_end(lambda: sources.write_committed(documents, path, checkpoint), spark, end)
    return sources.read_committed(spark, path)


def event_time_join_stream(spark, sf_dir):
    end = EndMarker.of(spark, f"{scratch_dir(spark)}/end")
    trades, customers = (
        streaming.with_end(view(spark, sf_dir, stream=True), end, LAG)
        for view in (views.trades, views.customers)
    )
    joined = streaming.event_time_join_stream(trades, customers, stretch=STRETCH)
    return _enriched(run_appending(joined, end))


def travel_features_query(spark, sf_dir):
    inside = operators.rides_in_bbox(views.rides(spark, sf_dir))
    features = travel_features()
    return inside.select(
        "ride_id",
        features["direction"].alias("direction"),
        F.round(features["distance_km"], 6).alias("distance_km"),
        features["distance_m"].alias("distance_m"),
        features["travel_minutes"].alias("travel_minutes"),
    )


def predict_travel_time(spark, sf_dir):
    return operators.predict_travel_time(views.rides(spark, sf_dir), grid=views.COARSE_GRID)


def predict_travel_time_stream(spark, sf_dir):
    rides = views.rides(spark, sf_dir, stream=True)
    return run_appending(streaming.predict_travel_time_stream(rides, grid=views.COARSE_GRID))


def predict_travel_time_pieces_stream(spark, sf_dir):
    rides, end = _ended(spark, _timed(views.rides(spark, sf_dir, stream=True)))
    predicted = streaming.predict_travel_time_stream(rides, grid=views.COARSE_GRID, piece=PIECE)
    return run_appending(predicted, end, chained=True)


def predict_travel_time_handover(spark, sf_dir):
    """The rides up to the middle of the time as a table, the later ones as a stream behind it."""
    rides = _timed(views.rides(spark, sf_dir))
    halves = F.expr("timestamp_micros((unix_micros(min(ts)) + unix_micros(max(ts))) div 2)")
    middle = rides.agg(halves).first()[0]
    early = rides.where(F.col("ts") <= F.lit(middle))
    stream = _timed(views.rides(spark, sf_dir, stream=True)).where(F.col("ts") > F.lit(middle))
    models = operators.travel_models(early, grid=views.COARSE_GRID)
    later = run_appending(streaming.predict_travel_time_stream(stream, grid=views.COARSE_GRID, models=models))
    return operators.predict_travel_time(early, grid=views.COARSE_GRID).unionByName(later)


def word_running_count_stream(spark, sf_dir):
    lines = views.lines(spark, sf_dir, stream=True)
    return run_appending(streaming.word_running_count_stream(lines, "doc_id", lines_per_piece=500, buckets=16), chained=True)


def ride_records(spark, sf_dir):
    return sources.rides_to_records(operators.rides_in_bbox(views.rides(spark, sf_dir)))


def ride_records_round_trip(spark, sf_dir):
    return sources.usable(sources.records_to_rides(ride_records(spark, sf_dir)), "start_time")


def read_car_events(spark, sf_dir):
    path = _car_event_files(spark, sf_dir)
    return sources.usable(sources.read_car_events(spark, path), "ts")


def read_car_events_stream(spark, sf_dir):
    path = _car_event_files(spark, sf_dir)
    return run_appending(sources.usable(sources.read_car_events(spark, path, streaming=True), "ts"))


def read_rides(spark, sf_dir):
    return sources.usable(
        sources.read_rides(spark, _ride_files(spark, sf_dir), **_RIDE_FORMAT), "start_time"
    )


def read_rides_stream(spark, sf_dir):
    rides = sources.read_rides(spark, _ride_files(spark, sf_dir), streaming=True, **_RIDE_FORMAT)
    return run_appending(sources.usable(rides, "start_time"))


_RIDE_FORMAT = {"timestampFormat": "yyyy-MM-dd HH:mm:ss.SSSSSS"}


def _car_event_files(spark, sf_dir) -> str:
    path = f"{scratch_dir(spark)}/cars"
    events = views.car_events(spark, sf_dir)
    events.withColumn("ts", F.unix_millis("ts")).write.csv(path)
    return path


def _ride_files(spark, sf_dir) -> str:
    path = f"{scratch_dir(spark)}/rides"
    rides_in_bbox(spark, sf_dir).write.options(compression="gzip", **_RIDE_FORMAT).csv(path)
    return path


def _timed(rides: DataFrame) -> DataFrame:
    return rides.withColumn("ts", ride_event_time())


def _ended(spark, events: DataFrame) -> tuple[DataFrame, EndMarker]:
    """A stream with a watermark and the marker that ends it."""
    end = EndMarker.of(spark, f"{scratch_dir(spark)}/end")
    return streaming.with_end(events, end, LAG), end


def _rounded(segments: DataFrame) -> DataFrame:
    # Sums of doubles depend on their order in the last digits.
    return segments.withColumn("avg_speed", F.round("avg_speed", 6))


def _enriched(joined: DataFrame) -> DataFrame:
    return joined.select(
        "trade_id",
        "customer_id",
        "ts",
        "amount",
        F.col("customer.ts").alias("known_since"),
        F.col("customer.value").alias("customer_value"),
    )


def _without_zone(query: Query) -> Query:
    """Event times are UTC; give them without a zone, as the tables have them."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        rows = query(spark, sf_dir)
        times = [f.name for f in rows.schema if isinstance(f.dataType, T.TimestampType)]
        return rows.withColumns({t: F.col(t).cast("timestamp_ntz") for t in times})

    return run


# name: (Spark query, DuckDB SQL)
CATALOG: dict[str, tuple[Query, str]] = {
    "word_count": (word_count, oracle.word_count()),
    "word_count_stream": (word_count_stream, oracle.word_count()),
    "word_running_count": (word_running_count, oracle.word_running_count()),
    "word_running_count_stream": (word_running_count_stream, oracle.word_running_count()),
    "rides_in_bbox": (rides_in_bbox, oracle.rides_in_bbox()),
    "rides_in_bbox_stream": (rides_in_bbox_stream, oracle.rides_in_bbox()),
    "grid_cells": (grid_cells, oracle.grid_cells()),
    "popular_places": (popular_places, oracle.popular_places()),
    "popular_places_stream": (popular_places_stream, oracle.popular_places()),
    "popular_places_panes_stream": (popular_places_panes_stream, oracle.popular_places()),
    "place_documents": (place_documents, oracle.place_documents()),
    "committed_places": (committed_places, oracle.place_documents()),
    "gap_segments": (gap_segments, oracle.gap_segments()),
    "gap_segments_stream": (gap_segments_stream, oracle.gap_segments()),
    "stop_segments_by_car": (stop_segments_by_car, oracle.stop_segments(keyed=True)),
    "stop_segments_global": (stop_segments_global, oracle.stop_segments(keyed=False)),
    "stop_segments_stream": (stop_segments_stream, oracle.stop_segments(keyed=True)),
    "stop_segments_global_stream": (stop_segments_global_stream, oracle.stop_segments(keyed=False)),
    "event_time_sort": (event_time_sort, oracle.event_time_sort()),
    "event_time_sort_stream": (event_time_sort_stream, oracle.car_events()),
    "late_rows": (late_rows, oracle.late_rows()),
    "event_time_join": (event_time_join, oracle.event_time_join()),
    "event_time_join_small": (event_time_join_small, oracle.event_time_join()),
    "event_time_join_stream": (event_time_join_stream, oracle.event_time_join()),
    "travel_features": (travel_features_query, oracle.travel_features()),
    "predict_travel_time": (predict_travel_time, oracle.predict_travel_time()),
    "predict_travel_time_stream": (predict_travel_time_stream, oracle.predict_travel_time()),
    "predict_travel_time_pieces_stream": (predict_travel_time_pieces_stream, oracle.predict_travel_time()),
    "predict_travel_time_handover": (predict_travel_time_handover, oracle.predict_travel_time()),
    "ride_records": (ride_records, oracle.ride_records()),
    "ride_records_round_trip": (ride_records_round_trip, oracle.rides_in_bbox()),
    "read_car_events": (read_car_events, oracle.car_events_file()),
    "read_car_events_stream": (read_car_events_stream, oracle.car_events_file()),
    "read_rides": (read_rides, oracle.rides_in_bbox()),
    "read_rides_stream": (read_rides_stream, oracle.rides_in_bbox()),
}


def queries() -> dict[str, Query]:
    return {name: _without_zone(query) for name, (query, _) in CATALOG.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for name, (_, sql) in CATALOG.items()}


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    return popular_places(spark, sf_dir)
