"""Event-time order per key, and rows that come too late for it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.hot_keys import ROWS_PER_PIECE, Running, find_hot_keys, ordered


def event_time_sort(
    events: DataFrame,
    keys: list[str],
    order: tuple[str, ...] = ("ts", "event_id"),
    partitions: int | None = None,
) -> DataFrame:
    """Rows of each key in ``order``, sorted within and across partitions.

    Partitions are ranges of key and order, so a large key spans several of them.
    """
    by = [*keys, *order]
    ranges = (
        events.repartitionByRange(*by)
        if partitions is None
        else events.repartitionByRange(partitions, *by)
    )
    return ranges.sortWithinPartitions(*by)


def event_time_position(
    events: DataFrame,
    keys: list[str],
    order: tuple[str, ...] = ("ts", "event_id"),
    rows_per_piece: int = ROWS_PER_PIECE,
) -> DataFrame:
    """Add ``seq``, the row's place in its key's event-time order, from 1."""
    hot = find_hot_keys(events, keys, list(order), rows_per_piece)
    rows = ordered(events, keys, list(order), hot)
    return rows.with_running(Running("seq", "sum", F.lit(1).cast("long"))).rows()


def late_rows(
    events: DataFrame,
    keys: list[str],
    arrival: tuple[str, ...],
    lag: str = "5 seconds",
    ts: str = "ts",
    rows_per_piece: int = ROWS_PER_PIECE,
) -> DataFrame:
    """Rows that are not newer than their key's watermark when they arrive.

    The watermark before a row is the newest event time that arrived earlier for
    the same key, less ``lag``. A stream has one watermark for all keys instead
    and moves it once per micro-batch, so it may drop other rows.
    """
    hot = find_hot_keys(events, keys, list(arrival), rows_per_piece)
    rows = ordered(events, keys, list(arrival), hot)
    rows = rows.with_running(Running("__newest", "max", F.col(ts), including=False)).rows()
    watermark = F.col("__newest") - F.expr(f"interval {lag}")
    return rows.withColumn("watermark", watermark).where(F.col(ts) <= watermark).drop("__newest")
