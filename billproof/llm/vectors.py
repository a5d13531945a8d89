"""Vectors in Arrow batches: which are whole, and their rows as one matrix."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F


def whole(vector: Column) -> Column:
    """True for vectors that are not null and hold no null or non-finite entry."""
    finite = F.forall(vector, lambda x: F.coalesce(F.abs(x.cast("double")) < F.lit(float("inf")), F.lit(False)))
    return F.coalesce(finite, F.lit(False))


def lengths(column: pa.ListArray) -> np.ndarray:
    return np.diff(column.offsets.to_numpy())


def matrix(column: pa.ListArray, length: int) -> np.ndarray:
    """The rows of a list column of equal lengths, as doubles."""
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, length)


def units(rows: np.ndarray) -> np.ndarray:
    """Rows at length one; scaled before squaring, so that neither tiny nor huge entries are lost."""
    if not rows.shape[1]:
        return rows
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.sqrt((rows * rows).sum(axis=1, keepdims=True))
