"""Session windows: runs of events of a key without a long pause."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.hot_keys import ROWS_PER_PIECE, Running, find_hot_keys, ordered


SUMMARY = ["start_ts", "end_ts", "n_events", "length_ms", "max_speed", "avg_speed"]


def weighted(events: DataFrame, point: list[str | Column], speed: str, copies: bool) -> DataFrame:
    """Events as ``n, speeds, total, top``, in addition to the columns of ``point``.

    With ``copies`` events that agree in ``point`` are added up to one row, partly
    before they are shuffled.
    """
    value = F.col(speed)
    if copies:
        return events.groupBy(*point).agg(
            F.count(F.lit(1)).alias("n"),
            F.count(value).alias("speeds"),
            F.sum(value).alias("total"),
            F.max(value).alias("top"),
        )
    return events.select(
        *point,
        F.lit(1).cast("long").alias("n"),
        value.isNotNull().cast("long").alias("speeds"),
        value.alias("total"),
        value.alias("top"),
    )


def segment_summary(ts: str) -> list[Column]:
    """What is reported about the `weighted` events of one segment."""
    length = F.unix_millis(F.max(ts)) - F.unix_millis(F.min(ts))
    return [
        F.min(ts).alias("start_ts"),
        F.max(ts).alias("end_ts"),
        F.sum("n").alias("n_events"),
        length.alias("length_ms"),
        F.max("top").alias("max_speed"),
        F.try_divide(F.sum("total"), F.sum("speeds")).alias("avg_speed"),
    ]


def gap_segments(
    events: DataFrame,
    keys: list[str],
    gap: str = "15 seconds",
    ts: str = "ts",
    speed: str = "speed",
    rows_per_piece: int = ROWS_PER_PIECE,
) -> DataFrame:
    """One row per session of a key; events at most ``gap`` apart share a session.

    Works on a stream with a watermark on ``ts`` too (append mode). In batch, keys
    with more than ``rows_per_piece`` events are handled in pieces.
    """
    if events.isStreaming:
        rows = weighted(events, [*keys, ts], speed, copies=False)
        sessions = rows.groupBy(*keys, F.session_window(ts, gap))
    else:
        events = events.where(F.col(ts).isNotNull())
        hot = find_hot_keys(events, keys, [ts], rows_per_piece)
        points = weighted(events, [*keys, ts], speed, copies=hot is not None and hot.copies)
        rows = ordered(points, keys, [ts], hot)
        rows = rows.with_running(Running("__previous", "max", F.col(ts), including=False))
        last_in_reach = F.col("__previous") + F.expr(f"interval {gap}")
        opens = F.col("__previous").isNull() | (F.col(ts) > last_in_reach)
        rows = rows.with_running(Running("__opened", "max", F.when(opens, F.col(ts))))
        sessions = rows.rows().groupBy(*keys, "__opened")
    return sessions.agg(*segment_summary(ts)).select(*keys, *SUMMARY)
