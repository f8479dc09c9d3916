"""Rides inside an area and the places that are popular for a while."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.geo import (
    NYC_BOX,
    NYC_GRID,
    BoundingBox,
    Grid,
    grid_cell,
    grid_cell_center,
    in_box,
    ride_event_time,
)


def rides_in_bbox(
    rides: DataFrame, box: BoundingBox = NYC_BOX, event_time: str | None = None
) -> DataFrame:
    """Rides that start and end inside ``box``.

    Rides whose column ``event_time`` is null are left out, if it is named. On a
    stream it is the watermarked column; the filter then stays above the
    watermark, so that rides outside the box still advance time.
    """
    inside = in_box(F.col("start_lon"), F.col("start_lat"), box) & in_box(
        F.col("end_lon"), F.col("end_lat"), box
    )
    if event_time is not None:
        inside = F.when(F.col(event_time).isNull(), F.lit(False)).otherwise(inside)
    return rides.where(inside)


def ride_cells(rides: DataFrame, grid: Grid = NYC_GRID) -> DataFrame:
    """Add ``ts`` and ``cell``: when and where each ride record happened.

    A start record happens at the start point, an end record at the end point. A
    column ``ts`` that is already there is kept, as it may carry a watermark.
    """
    if "ts" not in rides.columns:
        rides = rides.withColumn("ts", ride_event_time())
    lon = F.when(F.col("is_start"), F.col("start_lon")).otherwise(F.col("end_lon"))
    lat = F.when(F.col("is_start"), F.col("start_lat")).otherwise(F.col("end_lat"))
    return rides.withColumn("cell", grid_cell(lon, lat, grid))


def popular_places(
    rides: DataFrame,
    box: BoundingBox = NYC_BOX,
    grid: Grid = NYC_GRID,
    window: str = "15 minutes",
    slide: str = "5 minutes",
    threshold: int = 20,
    by_panes: bool = False,
) -> DataFrame:
    """Cells with more than ``threshold`` starts, or ends, in a sliding window.

    Gives ``lon, lat`` of the cell's middle, ``window_end`` in epoch milliseconds,
    ``is_start`` and ``cnt``. A stream needs a watermarked column ``ts`` from
    `tidemark.streaming.watermark.with_ride_watermark`; write it in append mode.

    A table's rides are counted once per slide interval, a pane, and panes added up. A stream
    does the same with ``by_panes``, in two stateful steps (so not in `strict_lateness`), if the
    slide divides the window: a ride then touches one count instead of one per window.
    """
    rides = rides_in_bbox(ride_cells(rides, grid), box, event_time="ts")
    in_panes = _divides(slide, window)
    if by_panes and not in_panes:
        raise ValueError("panes need a slide that divides the window")
    if rides.isStreaming and by_panes:
        panes = rides.groupBy(F.window("ts", slide), "cell", "is_start").agg(F.count(F.lit(1)).alias("cnt"))
        # A pane's last instant lies in the windows that the pane is a part of.
        timed = panes.withColumn("ts", F.window_time("window")).drop("window")
        counts = timed.groupBy(F.window("ts", window, slide), "cell", "is_start").agg(F.sum("cnt").alias("cnt"))
        counts = counts.withColumn("window_end", F.col("window.end"))
    elif rides.isStreaming or not in_panes:
        counts = rides.groupBy(F.window("ts", window, slide), "cell", "is_start").agg(
            F.count(F.lit(1)).alias("cnt")
        )
        counts = counts.withColumn("window_end", F.col("window.end"))
    else:
        # Count each stretch between two window ends once, then add stretches up.
        panes = rides.groupBy(F.window("ts", slide), "cell", "is_start").agg(
            F.count(F.lit(1)).alias("cnt")
        )
        first = F.col("window.end")
        step = F.expr(f"interval {slide}")
        ends = F.sequence(first, first + F.expr(f"interval {window}") - step, step)
        counts = (
            panes.select(F.explode(ends).alias("window_end"), "cell", "is_start", "cnt")
            .groupBy("window_end", "cell", "is_start")
            .agg(F.sum("cnt").alias("cnt"))
        )
    counts = counts.where(F.col("cnt") > threshold)
    lon, lat = grid_cell_center(F.col("cell"), grid)
    return counts.select(
        lon.alias("lon"),
        lat.alias("lat"),
        F.unix_millis("window_end").alias("window_end"),
        "is_start",
        F.col("cnt").cast("int").alias("cnt"),
    )


def _divides(slide: str, window: str) -> bool:
    try:
        return pd.Timedelta(window) % pd.Timedelta(slide) == pd.Timedelta(0)
    except ValueError:
        return False
