"""Whitening of embeddings by block Jacobi-Davidson over distributed centred products."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import stored
from tidemark.llm.vectors import dimension, matrix, whole_vectors

COMPONENTS = 32
SCALE, OFFSET = 64, 1_000_000
# Steps of the inner solver; one step is one pass over the rows for all components together.
INNER_STEPS = 4
_ROWS_AT_ONCE = 2_000
_OUT = (
    "vec_id long, component int, n long, deviation long, whitened double,"
    " explained double, identity_error double"
)

Product = Callable[[np.ndarray], np.ndarray]


def whitened(vectors: DataFrame, column: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """A row per vector and principal component: ``vec_id, component, n, deviation, whitened,
    explained, identity_error``.

    Entries become ``floor(64 * c) + 1000000``. The fit list is all usable vectors (see
    `whole_vectors` for those that are not); ``vec_id`` may be null or repeat, each row counts.
    Components are numbered from 1 by falling variance; those without variance beyond rounding
    are left out, as they cannot be scaled, so one row or equal rows give no result, like an
    empty table. ``deviation`` is exact, and null where it is beyond a long. Other columns are
    ignored.

    No matrix of the rows is built: the covariance is only ever applied, to a narrow block of
    columns, by one pass in which tasks subtract the exact mean, multiply twice and add up.
    """
    vec_id = F.col("vec_id").cast("long").alias("vec_id")
    rows = stored(whole_vectors(vectors, column, SCALE, OFFSET, vec_id))
    fit = _fit_list(rows)
    if fit is None:
        return rows.sparkSession.createDataFrame([], _OUT)
    values, axes = eigenpairs(lambda block: _applied(rows, fit, block), fit.dimension, components)
    total = _summed(rows, fit, lambda x: np.array([np.sum(x * x)]), 1)[0] / fit.n
    real = values > total * fit.dimension * 2 * np.finfo(float).eps
    values, axes = values[real], axes[:, real]
    if not len(values):
        return rows.sparkSession.createDataFrame([], _OUT)
    projection = axes / np.sqrt(values)
    k = len(values)
    covariance = _summed(rows, fit, lambda x: _gram(x @ projection), k * k).reshape(k, k) / fit.n
    error = float(np.abs(covariance - np.eye(k)).max())
    return rows.mapInArrow(_projected(fit, projection, values / total, error), _OUT)


@dataclass(frozen=True)
class FitList:
    """The number of vectors and the exact mean: whole parts and what is left over ``n``."""

    n: int
    whole: np.ndarray
    rest: list[int]

    @property
    def dimension(self) -> int:
        return len(self.rest)

    def centred(self, x: np.ndarray) -> np.ndarray:
        """Rows less the mean; subtracting whole parts first leaves small numbers to divide."""
        return (x - self.whole) - np.array([r / self.n for r in self.rest])

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """The exact sums of ``(n * x - S) ** 2``."""
        apart, rest = x - self.whole, np.array(self.rest)
        most = self.n * (float(np.abs(apart).max(initial=0)) + 1.0)
        if most * most * self.dimension < 2.0**62:
            scaled = apart * self.n - rest
            return (scaled * scaled).sum(axis=1).tolist()
        scaled = apart.astype(object) * self.n - rest.astype(object)
        exact = [int(sum(v * v for v in row)) for row in scaled]
        return [v if v < 2**63 else None for v in exact]


def _fit_list(rows: DataFrame) -> FitList | None:
    d = dimension(rows)

    def run(batches):
        n, sums = 0, [0] * d
        for batch in batches:
            x = matrix(batch.column("x"))
            n += len(x)
            # Sums of 32-bit halves cannot overflow.
            high, low = (x >> 32).sum(axis=0).tolist(), (x & 0xFFFFFFFF).sum(axis=0).tolist()
            sums = [s + (h << 32) + w for s, h, w in zip(sums, high, low)]
        if n:
            at = pa.array(range(d), pa.int32())
            total = pa.array([str(s) for s in sums])
            yield pa.RecordBatch.from_arrays([at, total, pa.array([n] * d, pa.int64())], ["at", "total", "n"])

    parts = rows.select("x").mapInArrow(run, "at int, total string, n long")
    total = F.sum(F.col("total").cast("decimal(38,0)")).alias("total")
    found = sorted(parts.groupBy("at").agg(total, F.sum("n").alias("n")).collect())
    if not found:
        return None
    n = found[0]["n"]
    parts = [divmod(int(r["total"]), n) for r in found]
    return FitList(n, np.array([q for q, _ in parts], np.int64), [r for _, r in parts])


def _summed(rows: DataFrame, fit: FitList, part: Callable[[np.ndarray], np.ndarray], size: int) -> np.ndarray:
    """``part`` of centred rows, ``size`` numbers a task, added up over all of them."""

    def run(batches):
        total = np.zeros(size)
        for batch in batches:
            total += part(fit.centred(matrix(batch.column("x"))))
        yield pa.RecordBatch.from_arrays([pa.array(range(size), pa.int32()), pa.array(total)], ["at", "value"])

    value: Column = F.sum("value").alias("value")
    sums = rows.select("x").mapInArrow(run, "at int, value double").groupBy("at").agg(value)
    out = np.zeros(size)
    for row in sums.collect():
        out[row["at"]] = row["value"]
    return out


def _applied(rows: DataFrame, fit: FitList, block: np.ndarray) -> np.ndarray:
    """The covariance applied to a block of columns."""
    part = lambda x: (x.T @ (x @ block)).ravel()
    return _summed(rows, fit, part, block.size).reshape(block.shape) / fit.n


def _gram(w: np.ndarray) -> np.ndarray:
    return (w.T @ w).ravel()


def _projected(fit: FitList, projection: np.ndarray, explained: np.ndarray, error: float):
    k = len(explained)

    def run(batches):
        for batch in batches:
            for i in range(0, batch.num_rows, _ROWS_AT_ONCE):
                part = batch.slice(i, _ROWS_AT_ONCE)
                x, m = matrix(part.column("x")), part.num_rows
                each = np.repeat(np.arange(m), k)
                columns = [
                    part.column("vec_id").take(pa.array(each)),
                    pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                    pa.array(np.full(m * k, fit.n)),
                    pa.array(fit.deviations(x), pa.int64()).take(pa.array(each)),
                    pa.array((fit.centred(x) @ projection).ravel()),
                    pa.array(np.tile(explained, m)),
                    pa.array(np.full(m * k, error)),
                ]
                yield pa.RecordBatch.from_arrays(columns, [f.split()[0] for f in _OUT.split(", ")])

    return run


def eigenpairs(product: Product, dimension: int, count: int) -> tuple[np.ndarray, np.ndarray]:
    """The greatest eigenvalues of a symmetric operator, falling, and unit eigenvectors as columns.

    Block Jacobi-Davidson. A search space is kept with its image. Rayleigh-Ritz gives candidates;
    those whose residual reached double precision are locked, from the greatest down. For each of
    the others `minres` solves the correction equation, projected off all candidates and locked
    vectors, for a few steps, all in lockstep, so that a step is one product. What it gives widens
    the space. Ends when all are locked or the space is whole, where nothing is left to correct.
    """
    count = min(count, dimension)
    start = np.random.default_rng(11).standard_normal((dimension, count))
    space = np.linalg.qr(start)[0]
    image = product(space)
    locked, values = np.zeros((dimension, 0)), np.zeros(0)
    while True:
        small = space.T @ image
        ritz, turn = np.linalg.eigh((small + small.T) / 2)
        turn = turn[:, ::-1]
        ritz, space, image = ritz[::-1], space @ turn, image @ turn
        wanted = count - len(values)
        residual = image[:, :wanted] - space[:, :wanted] * ritz[:wanted]
        scale = max(np.abs(ritz).max(), np.abs(values).max(initial=0.0))
        precise = np.linalg.norm(residual, axis=0) <= 4 * dimension * np.finfo(float).eps * scale
        whole = space.shape[1] + locked.shape[1] >= dimension
        ready = wanted if whole or precise.all() else int(np.argmin(precise))
        locked = np.hstack([locked, space[:, :ready]])
        values = np.concatenate([values, ritz[:ready]])
        if len(values) == count:
            order = np.argsort(-values, kind="stable")
            return values[order], locked[:, order]
        space, image, ritz, residual = space[:, ready:], image[:, ready:], ritz[ready:], residual[:, ready:]
        wanted -= ready
        if space.shape[1] > 3 * count:
            space, image = space[:, : 2 * count], image[:, : 2 * count]
        off = np.hstack([locked, space[:, :wanted]])

        def corrected(block: np.ndarray) -> np.ndarray:
            block = block - off @ (off.T @ block)
            out = product(block) - block * ritz[:wanted]
            return out - off @ (off.T @ out)

        step = minres(corrected, -residual, INNER_STEPS)
        fresh = _orthonormal(step, np.hstack([locked, space]))
        if not fresh.shape[1]:
            # All corrections lie in the space: any other direction is as good.
            fresh = _orthonormal(np.random.default_rng(len(values)).standard_normal(step.shape), np.hstack([locked, space]))
        space, image = np.hstack([space, fresh]), np.hstack([image, product(fresh)])


def minres(applied: Product, right: np.ndarray, steps: int) -> np.ndarray:
    """Approximate solutions of ``applied(t) = right``, column by column, in lockstep."""
    shape = right.shape[1]
    v_old, v = np.zeros_like(right), right.copy()
    gamma = np.linalg.norm(v, axis=0)
    eta, c_old, c, s_old, s = gamma.copy(), np.ones(shape), np.ones(shape), np.zeros(shape), np.zeros(shape)
    w_old, w, out = np.zeros_like(right), np.zeros_like(right), np.zeros_like(right)
    for _ in range(steps):
        v = v / _nonzero(gamma)
        image = applied(v)
        delta = (v * image).sum(axis=0)
        v_old, v = v, image - delta * v - gamma * v_old
        gamma_old, gamma = gamma, np.linalg.norm(v, axis=0)
        a0 = c * delta - c_old * s * gamma_old
        a1 = np.hypot(a0, gamma)
        a2 = s * delta + c_old * c * gamma_old
        a3 = s_old * gamma_old
        c_old, s_old, c, s = c, s, a0 / _nonzero(a1), gamma / _nonzero(a1)
        w_old, w = w, (v_old - a3 * w_old - a2 * w) / _nonzero(a1)
        out += c * eta * w
        eta = -s * eta
    return out


def _nonzero(x: np.ndarray) -> np.ndarray:
    return np.where(x == 0.0, 1.0, x)


def _orthonormal(block: np.ndarray, against: np.ndarray) -> np.ndarray:
    """An orthonormal base of what ``block`` adds to the space of ``against``."""
    room = against.shape[0] - against.shape[1]
    size = np.linalg.norm(block, axis=0)
    block = block[:, size > 0] / size[size > 0]
    for _ in range(2):
        block = block - against @ (against.T @ block)
    left, strength, _ = np.linalg.svd(block, full_matrices=False)
    left = left[:, strength > 1e-10][:, :room]
    left = left - against @ (against.T @ left)
    return np.linalg.qr(left)[0] if left.shape[1] else left
