"""Embeddings as matrices of whole numbers."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Squared distances of vectors with components below this stay exact in 64 bits.
LARGEST = 1 << 27
# Whole numbers up to here are exact in double precision, and so are sums of their products.
_EXACT = 1 << 53


def finite(embeddings: DataFrame, column: str = "embedding") -> DataFrame:
    """Rows whose vector is not NULL and holds no NULL or non-finite component; components as double."""
    values = F.col(column).cast("array<double>")
    wrong = F.exists(values, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == math.inf))
    return embeddings.where(values.isNotNull() & ~wrong).withColumn(column, values)


def whole(values: np.ndarray, scale: float) -> np.ndarray:
    """``floor(scale * x)`` of each component as 64-bit numbers; refuses what distances could not hold."""
    floored = np.floor(np.asarray(values, np.float64) * scale)
    if floored.size and np.abs(floored).max() >= LARGEST:
        raise ValueError(f"a scaled component is not within {LARGEST}: distances would not fit in 64 bits")
    return floored.astype(np.int64)


def matrix(column: pa.Array, scale: float) -> np.ndarray:
    """Lists of one length as a matrix of whole numbers, a row each."""
    rows = len(column)
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return whole(flat.reshape(rows, -1) if rows else np.empty((0, 0)), scale)


def squared_distances(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Exact squared distances of each point to each centre.

    Products go through floating-point matrices where every intermediate number is exact in
    them, and through 64-bit numbers where components are too large for that.
    """
    high = max(int(np.abs(points).max(initial=0)), int(np.abs(centres).max(initial=0)))
    if 4 * points.shape[1] * high * high < _EXACT:
        a, b = points.astype(np.float64), centres.astype(np.float64)
        return ((a * a).sum(1)[:, None] - 2 * (a @ b.T) + (b * b).sum(1)).astype(np.int64)
    found = np.empty((len(points), len(centres)), np.int64)
    for k, centre in enumerate(centres):
        found[:, k] = ((points - centre) ** 2).sum(1)
    return found
