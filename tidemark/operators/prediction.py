"""Travel times predicted from completed trips."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.geo import (
    DIRECTION_BUCKET_DEGREES,
    NYC_BOX,
    NYC_GRID,
    BoundingBox,
    Grid,
    grid_cell,
    ride_event_time,
    travel_features,
)
from tidemark.operators.hot_keys import ROWS_PER_PIECE, Running, find_hot_keys, ordered
from tidemark.operators.places import rides_in_bbox

MODEL_KEYS = ["cell", "bucket"]
MODEL_SUMS = ["n", "x", "y", "xx", "xy"]
REPLAY_ORDER = ["ts", "is_start", "ride_id"]


def trips(
    rides: DataFrame, box: BoundingBox = NYC_BOX, grid: Grid = NYC_GRID
) -> DataFrame:
    """What a model of travel times needs to know about each ride record in the box.

    Only starts and the ends that can train a model are of use: a record without a kind or a
    time, and an end without distance or travel time, is left out.
    """
    features = travel_features()
    if "ts" not in rides.columns:
        rides = rides.withColumn("ts", ride_event_time())
    of_use = F.col("is_start") | (F.col("distance_m").isNotNull() & F.col("travel_ms").isNotNull())
    records = rides_in_bbox(rides, box, event_time="ts").select(
        "ride_id",
        "is_start",
        "ts",
        grid_cell(F.col("end_lon"), F.col("end_lat"), grid).alias("cell"),
        F.floor(features["direction"] / F.lit(DIRECTION_BUCKET_DEGREES)).cast("int").alias("bucket"),
        features["distance_m"].alias("distance_m"),
        features["travel_ms"].alias("travel_ms"),
    )
    return records.where(F.col("is_start").isNotNull() & of_use)


def fitted_minutes(n: Column, x: Column, y: Column, xx: Column, xy: Column, at: Column) -> Column:
    """Least-squares line through n points, at a distance, in whole minutes.

    The sums are exact (metres and milliseconds). Null with fewer than two points
    or when all distances are equal.
    """
    wide = "decimal(38,0)"
    spread = (n.cast(wide) * xx.cast(wide) - x.cast(wide) * x.cast(wide)).cast("double")
    slope = (n.cast(wide) * xy.cast(wide) - x.cast(wide) * y.cast(wide)).cast("double") / spread
    n, x, y, at = (c.cast("double") for c in (n, x, y, at))
    minutes = F.round((y + slope * (n * at - x)) / n / F.lit(60000.0)).cast("int")
    return F.when((n >= 2) & (spread > 0), minutes)


def travel_models(rides: DataFrame, box: BoundingBox = NYC_BOX, grid: Grid = NYC_GRID) -> DataFrame:
    """What all end records of a table teach: ``cell, bucket`` and five sums, one row a model.

    A stream of later records can begin with it (`predict_travel_time_stream`).
    """
    x, y = F.col("distance_m"), F.col("travel_ms")
    # Sums of products outgrow 64 bits on a large table.
    wide_x, wide_y = x.cast("decimal(14,0)"), y.cast("decimal(14,0)")
    sums = {"n": F.count(F.lit(1)), "x": F.sum(x), "y": F.sum(y), "xx": F.sum(wide_x * wide_x), "xy": F.sum(wide_x * wide_y)}
    typed = [v.cast("decimal(38,0)" if len(c) == 2 else "bigint").alias(c) for c, v in sums.items()]
    return trips(rides, box, grid).where(~F.col("is_start")).groupBy(*MODEL_KEYS).agg(*typed)


def predict_travel_time(
    rides: DataFrame,
    box: BoundingBox = NYC_BOX,
    grid: Grid = NYC_GRID,
    rows_per_piece: int = ROWS_PER_PIECE,
) -> DataFrame:
    """``ride_id, predicted_minutes`` for every start record.

    There is one model per destination cell and 45 degree direction. It has seen
    the end records that come before the start record in (time, end before start,
    ride id) order.
    """
    records = trips(rides, box, grid)
    hot = find_hot_keys(records, MODEL_KEYS, REPLAY_ORDER, rows_per_piece)
    ended = ~F.col("is_start")
    x, y = F.col("distance_m"), F.col("travel_ms")

    def seen(name: str, value: Column) -> Running:
        return Running(name, "sum", F.when(ended, value), including=False)

    # Sums of products outgrow 64 bits on a large table.
    wide_x, wide_y = x.cast("decimal(14,0)"), y.cast("decimal(14,0)")
    rows = ordered(records, MODEL_KEYS, REPLAY_ORDER, hot).with_running(
        seen("n", F.lit(1).cast("long")),
        seen("x", x),
        seen("y", y),
        seen("xx", wide_x * wide_x),
        seen("xy", wide_x * wide_y),
    )
    minutes = fitted_minutes(*map(F.col, ("n", "x", "y", "xx", "xy")), x)
    return (
        rows.rows()
        .where("is_start")
        .select("ride_id", minutes.alias("predicted_minutes"))
    )
