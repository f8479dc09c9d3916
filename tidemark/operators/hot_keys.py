"""Ordered per-key computations that stay balanced when one key dominates.

A window function needs all rows of its key in one task. That is fine until one
key holds a large share of the table. The helpers here look for such keys in a
sample, cut their rows into consecutive pieces of bounded size, and let running
aggregates work per piece: what the earlier pieces add up to is aggregated
separately (one small row per piece) and joined back. Results do not depend on
where the cuts are, only the balance of the tasks does.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, replace

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.shared import written

ROWS_PER_PIECE = 4_000_000
SAMPLES_PER_PIECE = 100

_HOT = "__hot"
_PIECE = "__piece"
_CUTS = "__cuts"


@dataclass(frozen=True)
class HotKeys:
    """Cut points, in order, of every key that is too large for one task.

    ``copies`` tells that some rows of a key which no cut can part fill whole pieces.
    """

    cuts: pa.Table
    copies: bool

    @property
    def count(self) -> int:
        return sum(len(c) for c in self.cuts[_CUTS])


def find_hot_keys(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    rows_per_piece: int = ROWS_PER_PIECE,
    expand: Callable[[DataFrame], DataFrame] = lambda sample: sample,
    seed: int = 7,
) -> HotKeys | None:
    """Look for keys with more than ``rows_per_piece`` rows; ``None`` if there are none.

    Runs a job over a sample of the key and order columns, and further ones if there are
    such keys. What comes back to the driver is about one cut per ``rows_per_piece`` rows
    of hot keys. ``expand`` turns sampled rows into the rows that are to be cut, where
    those are dear.
    """
    per_piece = min(SAMPLES_PER_PIECE, rows_per_piece)
    fraction = per_piece / rows_per_piece
    rows = expand(df.sample(fraction=fraction, seed=seed) if fraction < 1 else df)
    # Equal points are added up before the shuffle, so copies cost nothing here.
    points = rows.groupBy(*keys, *order).agg(F.count(F.lit(1)).alias("__n"))
    largest = points.groupBy(*keys).agg(F.sum("__n").alias("__n")).agg(F.max("__n")).first()[0]
    if (largest or 0) < per_piece:
        return None
    step = F.lit(per_piece)
    cuts = (
        _counted_up(points, keys, order)
        .where(F.floor(F.col("__upto") / step) > F.floor((F.col("__upto") - F.col("__n")) / step))
        .groupBy(*keys)
        .agg(
            F.sort_array(F.collect_list(F.struct(*order))).alias(_CUTS),
            F.max("__n").alias("__n"),
        )
        .where(F.size(_CUTS) > 0)
        .toArrow()
    )
    if cuts.num_rows == 0:
        return None
    most = max(cuts["__n"].to_pylist())
    return HotKeys(cuts.drop_columns("__n"), copies=most >= 2 * per_piece)


def _counted_up(points: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Add ``__upto``: how many sampled rows of its key there are up to each point.

    The points are sorted in ranges, each in a task of its own, and only the sums of the
    ranges are added up key by key. So no task sees all points of a key.
    """
    # Written, as the ranges of a second run need not be the same.
    ranged = written(
        points.repartitionByRange(*keys, *order).withColumn("__range", F.spark_partition_id())
    )
    inside = Window.partitionBy(*keys, "__range").orderBy(*order)
    earlier = Window.partitionBy(*keys).orderBy("__range")
    sums = ranged.groupBy(*keys, "__range").agg(F.sum("__n").alias("__sum"))
    before = F.sum("__sum").over(earlier.rowsBetween(Window.unboundedPreceding, -1))
    sums = sums.select(*keys, "__range", F.coalesce(before, F.lit(0)).alias("__before"))
    local = F.sum("__n").over(inside.rowsBetween(Window.unboundedPreceding, 0))
    both = _left_join(ranged.withColumn("__local", local), sums, [*keys, "__range"])
    return both.withColumn("__upto", F.col("__local") + F.col("__before"))


@dataclass(frozen=True)
class Ordered:
    """Rows in ``order`` within ``keys``, with a piece number where keys are hot."""

    df: DataFrame
    keys: list[str]
    order: list[str]
    hot: bool

    @property
    def partition(self) -> list[str]:
        return [*self.keys, _HOT, _PIECE] if self.hot else self.keys

    def with_running(self, *running: Running) -> Ordered:
        """Add running aggregates as columns."""
        window = Window.partitionBy(*self.partition).orderBy(*self.order)
        local = {r.name: r.within(window) for r in running}
        if not self.hot:
            done = {name: r.finish(local[name]) for name, r in zip(local, running)}
            return replace(self, df=self.df.withColumns(done))
        earlier = (
            Window.partitionBy(*self.keys)
            .orderBy(_PIECE)
            .rowsBetween(Window.unboundedPreceding, -1)
        )
        point = F.struct(*self.order)
        # One row per piece of a hot key; Spark broadcasts them if they are few enough.
        carried = (
            self.df.where(_HOT)
            .groupBy(*self.partition)
            .agg(*[r.of_piece(point).alias(r.carry) for r in running])
            .withColumns({r.carry: r.fold(F.col(r.carry)).over(earlier) for r in running})
        )
        joined = _left_join(self.df.withColumns(local), carried, self.partition)
        done = {r.name: r.finish(r.combine(F.col(r.name), F.col(r.carry))) for r in running}
        return replace(self, df=joined.withColumns(done).drop(*[r.carry for r in running]))

    def rows(self) -> DataFrame:
        return self.df.drop(_HOT, _PIECE)


def ordered(df: DataFrame, keys: list[str], order: list[str], hot: HotKeys | None) -> Ordered:
    """Prepare ``df`` for running aggregates; ``hot`` comes from `find_hot_keys`.

    ``order`` must tell the rows of a key apart; rows that agree in it stay together.
    """
    if hot is not None:
        df = _with_piece(df, keys, order, hot)
    return Ordered(df, list(keys), list(order), hot is not None)


def cut_in_pieces(df: DataFrame, order: list[str], hot: HotKeys) -> DataFrame:
    """All of ``df`` as one sequence: ``__piece`` is the number of the piece of each row."""
    return _with_piece(df, [], order, hot).drop(_HOT)


def _with_piece(df: DataFrame, keys: list[str], order: list[str], hot: HotKeys) -> DataFrame:
    table = df.sparkSession.createDataFrame(hot.cuts)
    longest = max(len(c) for c in hot.cuts[_CUTS])
    if keys:
        df = _left_join(df, table, keys)
    else:
        df = df.withColumn(_CUTS, table.select(_CUTS).scalar())
    # Binary search for the number of cuts up to the row, one comparison per column.
    here = F.struct(*order)
    df = df.withColumns({_HOT: F.col(_CUTS).isNotNull(), _PIECE: F.lit(0)})
    for step in (2**i for i in reversed(range(longest.bit_length()))):
        passed = F.get(F.col(_CUTS), F.col(_PIECE) + F.lit(step - 1)) <= here
        df = df.withColumn(
            _PIECE, F.when(passed, F.col(_PIECE) + F.lit(step)).otherwise(F.col(_PIECE))
        )
    return df.drop(_CUTS)


@dataclass(frozen=True)
class Running:
    """A running aggregate over the rows of a key in order.

    ``kind`` is ``sum``, ``max`` or ``last`` (latest non-null value). With
    ``including`` false the row itself does not count.
    """

    name: str
    kind: str
    value: Column
    including: bool = True

    @property
    def carry(self) -> str:
        return f"__carry_{self.name}"

    def within(self, window) -> Column:
        frame = window.rowsBetween(Window.unboundedPreceding, 0 if self.including else -1)
        return self.fold(self.value).over(frame)

    def of_piece(self, point: Column) -> Column:
        if self.kind == "last":
            return F.max_by(self.value, F.when(self.value.isNotNull(), point))
        return self.fold(self.value)

    def combine(self, local: Column, carried: Column) -> Column:
        if self.kind == "sum":
            return F.coalesce(local + carried, local, carried)
        if self.kind == "max":
            return F.greatest(local, carried)
        return F.coalesce(local, carried)

    def finish(self, total: Column) -> Column:
        return F.coalesce(total, F.lit(0)) if self.kind == "sum" else total

    def fold(self, value: Column) -> Column:
        if self.kind == "sum":
            return F.sum(value)
        if self.kind == "max":
            return F.max(value)
        return F.last(value, ignorenulls=True)


def _left_join(df: DataFrame, small: DataFrame, on: list[str]) -> DataFrame:
    """Left join with a small table; null keys match each other."""
    renamed = small.withColumnsRenamed({k: f"__small_{k}" for k in on})
    same = [F.col(k).eqNullSafe(F.col(f"__small_{k}")) for k in on]
    return df.join(renamed, same, "left").drop(*[f"__small_{k}" for k in on])
