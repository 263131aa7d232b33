"""Helpers for tables of vectors."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F


def usable(vec: Column) -> Column:
    """True for vectors that take part: not NULL, not all zero, every component finite."""
    bad = F.exists(vec, lambda x: x.isNull() | F.isnan(x) | (F.abs(x.cast("double")) == float("inf")))
    return F.coalesce(vec.isNotNull() & ~bad & F.exists(vec, lambda x: x != 0), F.lit(False))


def matrix(column) -> np.ndarray:
    """A list column of equally long vectors as a float64 matrix."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if len(column) == 0:
        return np.zeros((0, 0))
    return np.asarray(column.flatten(), dtype=np.float64).reshape(len(column), -1)


def distinct_rows(x: np.ndarray) -> np.ndarray:
    """A number per row, the same for equal rows."""
    flat = np.ascontiguousarray(x + 0.0).view(np.dtype((np.void, x.shape[1] * x.itemsize))).ravel()
    return np.unique(flat, return_inverse=True)[1].ravel()
