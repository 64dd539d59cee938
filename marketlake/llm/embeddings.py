"""Shared by the operators on embedding vectors: Walsh-Hadamard transforms and vectors of Arrow lists."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F


def hadamard(rows: np.ndarray) -> np.ndarray:
    """The unnormalised Walsh-Hadamard transform of each row (natural order); the length is a power of two.

    Only additions and subtractions: exact on integers. The sum of a row's squares grows by the row's length.
    """
    count, size = rows.shape
    half = 1
    while half < size:
        pairs = rows.reshape(count, size // (2 * half), 2, half)
        rows = np.concatenate([pairs[:, :, :1] + pairs[:, :, 1:], pairs[:, :, :1] - pairs[:, :, 1:]], axis=2).reshape(count, size)
        half *= 2
    return rows


def matrix(lists: pa.Array, size: int) -> np.ndarray:
    """Lists of ``size`` numbers each, without nulls, as the rows of a matrix."""
    return lists.flatten().to_numpy(zero_copy_only=False).reshape(len(lists), size)


def all_finite(vector: str) -> Column:
    """Whether a vector is not null and holds neither nulls nor NaN nor infinities."""
    def finite(x: Column) -> Column:
        x = x.cast("double")
        return x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))

    return F.col(vector).isNotNull() & F.coalesce(F.forall(vector, finite), F.lit(False))
