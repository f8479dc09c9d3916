"""Travel times predicted on a stream of ride records."""

from __future__ import annotations

from decimal import Decimal

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor

from tidemark.functions.geo import NYC_BOX, NYC_GRID, BoundingBox, Grid
from tidemark.operators.prediction import MODEL_KEYS, MODEL_SUMS, fitted_minutes, trips
from tidemark.streaming.pieces import LANES, Apply, Carry, Fold, in_pieces
from tidemark.streaming.state import gather, stretch_us

_MODEL = "n bigint, x bigint, y bigint, xx decimal(38,0), xy decimal(38,0)"
_SEEN = f"ride_id bigint, at bigint, {_MODEL}"
_RECORD = ["event_us", "is_start", "ride_id", "distance_m", "travel_ms"]


def predict_travel_time_stream(
    rides: DataFrame,
    box: BoundingBox = NYC_BOX,
    grid: Grid = NYC_GRID,
    models: DataFrame | None = None,
    piece: str | None = None,
) -> DataFrame:
    """``ride_id, predicted_minutes`` for every start record, as soon as it arrives.

    The model of a destination cell and direction is five sums over the end records
    that arrived so far. Records of one micro-batch are taken in event-time order.
    Write the result in append mode, started inside `keyed_processors`.

    ``models``, a table from `travel_models`, is what the models begin with in the first run of
    the stream: the records of a table handed over to the stream that goes on behind it.

    With ``piece``, a length of time, records are taken in event-time order throughout, once the
    watermark on ``ts`` has passed the end of their piece, and a model with very many records is
    worked on by many tasks: each adds up one piece of it, one step carries the sums of pieces
    on, and the predictions of a piece are made from both. No task holds more than a piece. Do
    not use `strict_lateness` then, which allows one stateful step only.
    """
    if models is not None and piece is not None:
        raise ValueError("models are handed over to streams without pieces")
    # A start needs no travel time; a null would turn the whole column into floats.
    known = F.coalesce("travel_ms", F.lit(0).cast("bigint"))
    rows = trips(rides, box, grid).withColumns({"event_us": F.unix_micros("ts"), "travel_ms": known})
    model_types = ", ".join(f"{k} int" for k in MODEL_KEYS)
    if piece is None:
        begun = models.select(*MODEL_KEYS, *MODEL_SUMS).groupBy(*MODEL_KEYS) if models is not None else None
        seen = rows.drop("ts").groupBy(*MODEL_KEYS).transformWithStateInPandas(
            _Learn(), _SEEN, "append", "None", begun
        )
    else:
        names, width = [*MODEL_KEYS, "piece"], stretch_us(piece)
        schema = f"{model_types}, piece bigint, lane int, summary boolean, {_SEEN}"
        folded = in_pieces(rows, MODEL_KEYS, width).transformWithStateInPandas(
            Fold(names, _RECORD, _piece_of_model, width), schema, "append", "EventTime"
        )
        carried = folded.groupBy(*MODEL_KEYS, "lane").transformWithStateInPandas(
            Carry([*MODEL_KEYS, "lane"], ["piece"], _MODEL, _carried), schema, "append", "None"
        )
        seen = carried.groupBy(*names).transformWithStateInPandas(Apply(_with_carry), _SEEN, "append", "None")
    minutes = fitted_minutes(*map(F.col, MODEL_SUMS), F.col("at"))
    return seen.select("ride_id", minutes.alias("predicted_minutes"))


def _learned(us, is_start, ride_id, x, y):
    """For each start, in order: its ride, its distance and the sums before it; then all sums."""
    order = np.lexsort((ride_id, is_start, us))
    ended = ~is_start[order].astype(bool)
    at, ride_id = x[order][~ended], ride_id[order][~ended]
    x, y = x[order] * ended, y[order] * ended
    # Products outgrow 64 bits, so they are added up as Python's integers.
    big_x, big_y = x.astype(object), y.astype(object)
    sums = [np.cumsum(v) for v in (ended.astype("int64"), x, y, big_x * big_x, big_x * big_y)]
    # A start adds nothing to the sums, so its own row holds what came before it.
    return ride_id, at, [v[~ended] for v in sums], [int(v[-1]) if len(v) else 0 for v in sums]


def _rows(ride_id, at, sums, before) -> dict:
    columns = [v + b for v, b in zip(sums[:3], before[:3])]
    columns += [[Decimal(int(v) + int(b)) for v in column] for column, b in zip(sums[3:], before[3:])]
    return {"ride_id": ride_id, "at": at, **dict(zip(MODEL_SUMS, columns))}


def _packed(sums) -> tuple:
    n, x, y, xx, xy = map(int, sums)
    return n, x, y, Decimal(xx), Decimal(xy)


class _Learn(StatefulProcessor):
    def init(self, handle) -> None:
        self.model = handle.getValueState("model", _MODEL)

    def handleInitialState(self, key, initialState, timerValues) -> None:
        self.model.update(_packed(initialState[MODEL_SUMS].iloc[0]))

    def handleInputRows(self, key, rows, timerValues):
        before = [int(v) for v in self.model.get()] if self.model.exists() else [0] * len(MODEL_SUMS)
        ride_id, at, sums, total = _learned(*gather(rows, *_RECORD))
        if total[0]:
            self.model.update(_packed(t + b for t, b in zip(total, before)))
        if len(ride_id):
            yield pd.DataFrame(_rows(ride_id, at, sums, before))

    def close(self) -> None:
        pass


def _piece_of_model(piece: int, *record) -> pd.DataFrame:
    """The starts of a piece with the sums of that piece alone, and its summary."""
    ride_id, at, sums, total = _learned(*record)
    starts = pd.DataFrame(_rows(ride_id, at, sums, [0] * len(sums))).assign(lane=1 + piece % LANES, summary=False)
    whole = dict(zip(MODEL_SUMS, _packed(total)))
    summary = pd.DataFrame([{"ride_id": 0, "at": 0, **whole, "lane": 0, "summary": True}])
    return pd.concat([starts, summary], ignore_index=True) if len(starts) else summary


def _carried(model: tuple | None, summaries: pd.DataFrame) -> tuple[tuple, pd.DataFrame]:
    """Each piece's summary replaced by the sums before the piece."""
    sums = [int(v) for v in model] if model else [0] * len(MODEL_SUMS)
    before = []
    for own in summaries[MODEL_SUMS].itertuples(index=False):
        before.append(_packed(sums))
        sums = [s + int(v) for s, v in zip(sums, own)]
    return _packed(sums), summaries.assign(**dict(zip(MODEL_SUMS, map(list, zip(*before)))))


def _with_carry(rows: pd.DataFrame) -> pd.DataFrame:
    is_summary = rows["summary"].astype(bool)
    before = rows[is_summary][MODEL_SUMS].iloc[0]
    starts = rows[~is_summary]
    sums = [starts[c].to_numpy() for c in MODEL_SUMS]
    return pd.DataFrame(_rows(starts["ride_id"].to_numpy(), starts["at"].to_numpy(), sums, before))
