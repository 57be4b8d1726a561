"""Vectors as the two vector operators read them."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F


def usable(embedding: Column) -> Column:
    """Whether a vector has a direction: not null or empty, all components finite, not all zero."""
    finite = F.forall(embedding, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(embedding.isNotNull() & finite & F.exists(embedding, lambda x: x != 0), F.lit(False))


def matrix(column: pa.ChunkedArray) -> np.ndarray:
    """Rows of equal length as doubles."""
    lists = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return np.asarray(lists.flatten(), np.float64).reshape(len(lists), -1)


def unit(x: np.ndarray) -> np.ndarray:
    """Rows at length 1; scaled first, so that very large or small components neither overflow nor vanish."""
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))
