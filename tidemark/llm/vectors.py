"""Vectors of a table as whole numbers."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def whole_vectors(vectors: DataFrame, column: str, scale: int, offset: int, *others) -> DataFrame:
    """``others`` and ``x``, the entries ``floor(scale * c) + offset`` of every usable vector.

    Null and empty vectors, those with a null or non-finite entry and those of another length than
    most (of equally common lengths, the greatest) are left out. Entries stay within 2**62.
    """
    c = F.col(column)
    sizes = vectors.where(F.size(c) > 0).groupBy(F.size(c).alias("size")).count()
    most = sizes.orderBy(F.desc("count"), F.desc("size")).first()
    usable = (F.size(c) == (most["size"] if most else -1)) & F.forall(
        c, lambda e: e.isNotNull() & (F.abs(e.cast("double")) < F.lit(math.inf))
    )
    bound = F.lit(2.0**61)

    def whole(e):
        scaled = F.least(F.greatest(e.cast("double") * F.lit(float(scale)), -bound), bound)
        return F.floor(scaled) + F.lit(offset).cast("long")

    return vectors.where(F.coalesce(usable, F.lit(False))).select(*others, F.transform(c, whole).alias("x"))


def matrix(column: pa.Array) -> np.ndarray:
    """The lists of equal length of a column as rows of a matrix."""
    n = len(column)
    values = column.flatten().to_numpy(zero_copy_only=False)
    return values.reshape(n, -1) if n else values.reshape(0, 1)


def dimension(x: DataFrame) -> int:
    first = x.select(F.size("x").alias("n")).first()
    return first["n"] if first else 0
