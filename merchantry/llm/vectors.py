"""Embeddings as rows of doubles."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F


def usable(vector: Column) -> Column:
    """Not null, not zero, no null or non-finite component."""
    large = F.lit(1.7976931348623157e308)
    finite = F.forall(vector, lambda x: F.coalesce(F.abs(x.cast("double")) <= large, F.lit(False)))
    return F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """The vectors of a column of lists of equal length."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def unit(x: np.ndarray) -> np.ndarray:
    """Scaled to length 1 in doubles, also where squares would overflow or vanish."""
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))
