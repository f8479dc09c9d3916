"""Keys cut into pieces of time or order, so that no task follows a whole key.

Three stateful steps in a chain. `Fold` works on one piece of a key and gives rows, plus a
summary of the piece; `Carry` goes through the summaries of a key in order and keeps what they
add up to; `Apply` gives it to the rows of each piece. Rows between the steps have a ``lane``:
summaries go in lane 0 of their key, the others in lanes that other tasks pass on untouched.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, GroupedData
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor

from tidemark.streaming.state import gather

LANES = 64


def in_pieces(rows: DataFrame, keys: list[str], width_us: int) -> GroupedData:
    """Rows with a column ``event_us`` grouped by key and piece of time."""
    piece = F.expr(f"(event_us - pmod(event_us, {width_us}L)) div {width_us}L")
    return rows.withColumn("piece", piece).groupBy(*keys, "piece")


class Fold(StatefulProcessor):
    """Gives ``fold(piece, *columns)`` of the rows of each piece.

    ``names`` are the grouping columns, the last one the piece. With ``width_us`` rows are kept,
    each batch's behind those before, until the watermark has passed the end of the piece;
    without, the rows of each batch are a piece of their own.
    """

    def __init__(self, names: list[str], columns: list[str], fold: Callable[..., pd.DataFrame], width_us: int | None):
        self.names, self.columns, self.fold, self.width = names, columns, fold, width_us

    def init(self, handle) -> None:
        self.handle = handle
        if self.width:
            self.rows = handle.getListState("rows", "kinds string, packed array<binary>")

    def handleInputRows(self, key, rows, timerValues):
        arrived = gather(rows, *self.columns)
        if not self.width:
            yield from self._given(key, arrived)
            return
        if not self.rows.exists():
            self.handle.registerTimer((int(key[-1]) + 1) * self.width // 1000)
        kinds = ",".join(column.dtype.str for column in arrived)
        self.rows.appendValue((kinds, [column.tobytes() for column in arrived]))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        chunks = [
            [np.frombuffer(bytes(p), kind) for kind, p in zip(kinds.split(","), packed)]
            for kinds, packed in self.rows.get()
        ]
        self.rows.clear()
        yield from self._given(key, [np.concatenate(parts) for parts in zip(*chunks)])

    def _given(self, key, columns):
        found = self.fold(int(key[-1]), *columns)
        if len(found):
            yield pd.DataFrame({k: [v] * len(found) for k, v in zip(self.names, key)}).join(found)

    def close(self) -> None:
        pass


class Carry(StatefulProcessor):
    """``step(state, summaries)`` gives the new state and rows; summaries are sorted by ``order``.

    Pieces of a later micro-batch follow those of earlier ones, so one small state a key does.
    Lanes other than 0 are passed on.
    """

    def __init__(self, names: list[str], order: list[str], state: str, step: Callable):
        self.names, self.order, self.schema, self.step = names, order, state, step

    def init(self, handle) -> None:
        self.state = handle.getValueState("carried", self.schema)

    def handleInputRows(self, key, rows, timerValues):
        if key[-1] != 0:
            yield from rows
            return
        found = pd.concat(list(rows)).sort_values(self.order, ignore_index=True)
        state, out = self.step(tuple(self.state.get()) if self.state.exists() else None, found)
        self.state.update(state)
        if len(out):
            yield out

    def close(self) -> None:
        pass


class Apply(StatefulProcessor):
    """``apply(rows)`` of a piece whose rows and carried summary come in one micro-batch."""

    def __init__(self, apply: Callable[[pd.DataFrame], pd.DataFrame]):
        self.apply = apply

    def init(self, handle) -> None:
        pass

    def handleInputRows(self, key, rows, timerValues):
        out = self.apply(pd.concat(list(rows), ignore_index=True))
        if len(out):
            yield out

    def close(self) -> None:
        pass
