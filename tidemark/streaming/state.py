"""What the stateful processors of streams share."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import SparkSession

import tidemark

# State functions travel with their query, so executors need not have the package.
cloudpickle.register_pickle_by_value(tidemark)

_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@contextmanager
def keyed_processors(spark: SparkSession) -> Iterator[None]:
    """Start queries with stateful processors in here: they need a store of named states."""
    before = spark.conf.get(_PROVIDER, None)
    spark.conf.set(_PROVIDER, _ROCKSDB)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_PROVIDER)
        else:
            spark.conf.set(_PROVIDER, before)


def gather(batches: Iterator[pd.DataFrame], *columns: str) -> list[np.ndarray]:
    """Columns of the new rows of one key in this micro-batch."""
    parts = list(batches)
    return [np.concatenate([part[c].to_numpy() for part in parts] or [[]]) for c in columns]


class Held:
    """Rows of a key that wait for the watermark.

    They are kept in chunks, each of one stretch of event time and one micro-batch, under the
    time of their first row. A batch writes the chunks of what arrived and, once the watermark
    has passed rows, the one chunk of which only a part is due; all others stay untouched. One
    timer a key waits for the first row.

    ``columns`` are names with numpy types; ``object`` columns hold strings.
    """

    def __init__(self, handle, stretch_us: int, columns: dict[str, str]):
        self.handle, self.stretch, self.columns = handle, stretch_us, columns
        kinds = (f"{c} {'array<string>' if kind == 'object' else 'binary'}" for c, kind in columns.items())
        self.chunks = handle.getMapState("held", "first_us bigint, part bigint", ", ".join(kinds))
        self.timer = handle.getValueState("timer", "ms bigint")

    def add(self, us: np.ndarray, rows: list[np.ndarray], part: int, watermark_us: int) -> None:
        """Hold new rows; ``part`` numbers the micro-batch."""
        if not len(us):
            return
        order = np.argsort(us, kind="stable")
        us, rows = us[order], [column[order] for column in rows]
        cuts = np.flatnonzero(np.diff(us // self.stretch, prepend=us[0] // self.stretch - 1))
        for i, j in zip(cuts, [*cuts[1:], len(us)]):
            self._put(int(us[i]), part, [us[i:j], *(column[i:j] for column in rows)])
        self._wake(int(us[0]), watermark_us)

    def take(self, watermark_us: int) -> list[np.ndarray]:
        """The rows up to the watermark, which are held no longer."""
        due, waiting = [], []
        for key in list(self.chunks.keys()):
            (due if key[0] <= watermark_us else waiting).append((int(key[0]), int(key[1])))
        taken = []
        for first_us, part in sorted(due):
            chunk = self._get(first_us, part)
            self.chunks.removeKey((first_us, part))
            n = int(np.searchsorted(chunk[0], watermark_us, side="right"))
            taken.append([column[:n] for column in chunk])
            if n < len(chunk[0]):
                rest = [column[n:] for column in chunk]
                self._put(int(rest[0][0]), part, rest)
                waiting.append((int(rest[0][0]), part))
        self.timer.clear()
        if waiting:
            self._wake(min(waiting)[0], watermark_us)
        return [np.concatenate(parts) for parts in zip(*taken)] if taken else self._nothing()

    def look(self, upto_us: int) -> list[np.ndarray]:
        """The rows up to a time, which stay held."""
        keys = sorted((int(k[0]), int(k[1])) for k in self.chunks.keys())
        found = [self._get(*k) for k in keys if k[0] <= upto_us]
        return [np.concatenate(parts) for parts in zip(*found)] if found else self._nothing()

    def _nothing(self) -> list[np.ndarray]:
        return [np.zeros(0, kind) for kind in self.columns.values()]

    def _put(self, first_us: int, part: int, rows: list[np.ndarray]) -> None:
        packed = (
            column.tolist() if kind == "object" else column.astype(kind).tobytes()
            for column, kind in zip(rows, self.columns.values())
        )
        self.chunks.updateValue((first_us, part), tuple(packed))

    def _get(self, first_us: int, part: int) -> list[np.ndarray]:
        found = self.chunks.getValue((first_us, part))
        return [
            np.array(value, object) if kind == "object" else np.frombuffer(bytes(value), kind)
            for value, kind in zip(found, self.columns.values())
        ]

    def _wake(self, first_us: int, watermark_us: int) -> None:
        """Have the key called once the watermark reaches ``first_us``."""
        due_ms = max(-(-first_us // 1000) - 1, watermark_us // 1000 + 1)
        before = self.timer.get() if self.timer.exists() else None
        if before is not None and before[0] <= due_ms:
            return
        if before is not None:
            self.handle.deleteTimer(int(before[0]))
        self.handle.registerTimer(due_ms)
        self.timer.update((due_ms,))


def stretch_us(stretch: str) -> int:
    """A length of time in microseconds; whole milliseconds, as the watermark counts them."""
    return max(1, int(pd.Timedelta(stretch) / pd.Timedelta("1ms"))) * 1000
