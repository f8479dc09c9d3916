"""Stop-delimited segments of a stream."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor

from tidemark.streaming.pieces import LANES, Carry, Fold, in_pieces
from tidemark.streaming.state import Held, gather, stretch_us

_SUMMARY = "start_us bigint, end_us bigint, n_events bigint, max_speed double, avg_speed double"
_OPEN = "n bigint, speeds bigint, start_us bigint, total double, top double"
_NOTHING = (0, 0, 0, 0.0, math.nan)
_RUN = "at int, closed boolean, start_us bigint, end_us bigint, n bigint, speeds bigint, total double, top double"


def stop_segments_stream(
    events: DataFrame,
    keys: list[str] | None = None,
    ts: str = "ts",
    tie: str = "event_id",
    speed: str = "speed",
    stretch: str = "1 minute",
    piece: str | None = None,
) -> DataFrame:
    """Segments of each key, given once the watermark has passed their stop.

    ``events`` needs a watermark on ``ts``; events at or below it are dropped. Write the result in
    append mode, started inside `keyed_processors`. ``tie`` is a whole number that orders events
    of the same time. Per key the state holds a few numbers for the open segment and, in chunks of
    one ``stretch`` of time, the events that are newer than the watermark.

    Without ``keys`` all events form one sequence. For it, and for keys with very many events,
    give ``piece``, a length of time: each piece of a key is summed up by a task of its own once
    the watermark has passed its end (the segments inside it, and the open runs at its two ends),
    and a second stateful step joins the open runs of consecutive pieces. No task then holds more
    than a piece. Segments come out a piece at a time; do not use `strict_lateness`, which allows
    one stateful step only.
    """
    keys = list(keys or [])
    if not keys and piece is None:
        raise ValueError("events without keys need pieces")
    key_types = [f"`{k}` {events.schema[k].dataType.simpleString()}" for k in keys]
    rows = events.select(
        *keys,
        ts,
        F.unix_micros(ts).alias("event_us"),
        F.col(tie).cast("long").alias("event_tie"),
        F.col(speed).cast("double").alias("event_speed"),
    )
    if piece is None:
        segments = rows.groupBy(*keys).transformWithStateInPandas(
            _Follow(keys, stretch_us(stretch)), ", ".join([*key_types, _SUMMARY]), "append", "EventTime"
        )
    else:
        width = stretch_us(piece)
        schema = ", ".join([*key_types, "piece bigint, lane int", _RUN])
        runs = in_pieces(rows, keys, width).transformWithStateInPandas(
            Fold([*keys, "piece"], ["event_us", "event_tie", "event_speed"], _runs_of_piece, width), schema, "append", "EventTime"
        )
        joined = runs.groupBy(*keys, "lane").transformWithStateInPandas(
            Carry([*keys, "lane"], ["piece", "at"], _OPEN, _joined), schema, "append", "None"
        )
        average = F.try_divide("total", "speeds").alias("avg_speed")
        segments = joined.select(*keys, "start_us", "end_us", F.col("n").alias("n_events"), F.col("top").alias("max_speed"), average)
    start, end = F.timestamp_micros("start_us"), F.timestamp_micros("end_us")
    return segments.select(
        *keys,
        start.alias("start_ts"),
        end.alias("end_ts"),
        "n_events",
        (F.unix_millis(end) - F.unix_millis(start)).alias("length_ms"),
        # No known speed is null, as in a table.
        F.nanvl("max_speed", F.lit(None)).alias("max_speed"),
        F.nanvl("avg_speed", F.lit(None)).alias("avg_speed"),
    ).where(F.col("length_ms") > 0)


def _runs(us: np.ndarray, tie: np.ndarray, speed: np.ndarray) -> pd.DataFrame:
    """Runs of rows in order: each ends at a stop, the last one may still be open."""
    order = np.lexsort((tie, us))
    us, speed = us[order], speed[order]
    stops = np.flatnonzero(speed == 0.0)
    first = np.concatenate([[0], stops + 1])
    first = first[first < len(us)].astype(np.int64)
    if not len(first):
        return pd.DataFrame({c.split()[0]: [] for c in _RUN.split(", ")})
    last = np.concatenate([first[1:], [len(us)]]) - 1
    known = ~np.isnan(speed)
    return pd.DataFrame(
        {
            "at": np.arange(len(first)),
            "closed": np.arange(len(first)) < len(stops),
            "start_us": us[first],
            "end_us": us[last],
            "n": last - first + 1,
            "speeds": np.add.reduceat(known.astype("int64"), first),
            "total": np.add.reduceat(np.where(known, speed, 0.0), first),
            "top": np.fmax.reduceat(speed, first),
        }
    )


def _continued(open_run: tuple, runs: pd.DataFrame) -> pd.DataFrame:
    """The runs, of which the first goes on with the one that was open before."""
    n, speeds, start, total, top = open_run
    if n and len(runs):
        runs = runs.copy()
        for name, value in (("n", n), ("speeds", speeds), ("total", total)):
            runs.loc[0, name] += value
        runs.loc[0, "start_us"] = start
        runs.loc[0, "top"] = np.fmax(runs.loc[0, "top"], top)
    return runs


def _left_open(runs: pd.DataFrame, before: tuple) -> tuple:
    if not len(runs):
        return before
    last = runs.iloc[-1]
    if last["closed"]:
        return _NOTHING
    return int(last["n"]), int(last["speeds"]), int(last["start_us"]), float(last["total"]), float(last["top"])


class _Follow(StatefulProcessor):
    """Follows each key from stop to stop as the watermark goes on."""

    def __init__(self, keys: list[str], stretch: int):
        self.keys, self.stretch = keys, stretch

    def init(self, handle) -> None:
        self.held = Held(handle, self.stretch, {"us": "int64", "tie": "int64", "speed": "float64"})
        self.open = handle.getValueState("open", _OPEN)

    def handleInputRows(self, key, rows, timerValues):
        watermark = timerValues.getCurrentWatermarkInMs() * 1000
        us, tie, speed = gather(rows, "event_us", "event_tie", "event_speed")
        fresh = us > watermark
        self.held.add(us[fresh], [tie[fresh], speed[fresh]], timerValues.getCurrentProcessingTimeInMs(), watermark)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        before = tuple(self.open.get()) if self.open.exists() else _NOTHING
        runs = _continued(before, _runs(*self.held.take(timerValues.getCurrentWatermarkInMs() * 1000)))
        after = _left_open(runs, before)
        if after[0]:
            self.open.update(after)
        elif before[0]:
            self.open.clear()
        closed = runs[runs["closed"].astype(bool)]
        if len(closed):
            out = {k: [v] * len(closed) for k, v in zip(self.keys, key)}
            out |= {"start_us": closed["start_us"], "end_us": closed["end_us"], "n_events": closed["n"]}
            out |= {"max_speed": closed["top"], "avg_speed": closed["total"] / closed["speeds"].replace(0, np.nan)}
            yield pd.DataFrame(out)

    def close(self) -> None:
        pass


def _runs_of_piece(piece: int, us: np.ndarray, tie: np.ndarray, speed: np.ndarray) -> pd.DataFrame:
    runs = _runs(us, tie, speed)
    # Only the first run and an open last one can reach over the ends of the piece.
    inside = runs["closed"].astype(bool) & (runs["at"] > 0)
    return runs.assign(lane=np.where(inside, 1 + piece % LANES, 0))


def _joined(open_run: tuple | None, runs: pd.DataFrame) -> tuple[tuple, pd.DataFrame]:
    """Runs at the ends of consecutive pieces: open ones go on in the next."""
    n, speeds, start, total, top = open_run or _NOTHING
    out = []
    for run in runs.itertuples(index=False):
        start = start if n else run.start_us
        n, speeds, total, top = n + run.n, speeds + run.speeds, total + run.total, np.fmax(top, run.top)
        if run.closed:
            out.append(run._replace(start_us=start, n=n, speeds=speeds, total=total, top=top))
            n, speeds, start, total, top = _NOTHING
    after = (int(n), int(speeds), int(start), float(total), float(top))
    return after, pd.DataFrame(out, columns=runs.columns)
