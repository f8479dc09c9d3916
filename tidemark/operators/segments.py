"""Segments that end at a stop."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.hot_keys import ROWS_PER_PIECE, Running, find_hot_keys, ordered
from tidemark.operators.sessions import SUMMARY, segment_summary, weighted


def stop_segments(
    events: DataFrame,
    keys: list[str] | None = None,
    order: tuple[str, ...] = ("ts", "event_id"),
    speed: str = "speed",
    rows_per_piece: int = ROWS_PER_PIECE,
) -> DataFrame:
    """One row per run of events up to and including an event with speed 0.

    Without ``keys`` all events form one sequence. Segments of length 0 (usually a
    stop right after a stop) are left out, and so are events after the last stop.
    ``order`` is the sequence; its first column is the event time. Events without
    a time are left out.
    """
    keys, order, ts = list(keys or []), list(order), order[0]
    events = events.where(F.col(ts).isNotNull())
    hot = find_hot_keys(events, keys, order, rows_per_piece)
    copies = hot is not None and hot.copies
    is_stop = F.coalesce(F.col(speed) == F.lit(0.0), F.lit(False)).alias("__stop")
    points = weighted(events, [*keys, *order, is_stop], speed, copies)
    if copies:
        # The first of several equal stops ends the segment, the others have no length.
        points = points.withColumns(
            {c: F.when(F.col("__stop"), F.lit(1)).otherwise(F.col(c)) for c in ("n", "speeds")}
        )
    stop = F.col("__stop")
    stops_before = Running("__segment", "sum", stop.cast("long"), including=False)
    return (
        ordered(points, keys, order, hot)
        .with_running(stops_before)
        .rows()
        .groupBy(*keys, "__segment")
        .agg(*segment_summary(ts), F.bool_or(stop).alias("__closed"))
        .where(F.col("__closed") & (F.col("length_ms") > 0))
        .select(*keys, *SUMMARY)
    )
