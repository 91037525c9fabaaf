"""Embedding columns: which rows take part, and float blocks from Arrow lists."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F


def usable(vector: Column) -> Column:
    """True for a non-empty vector without null, NaN or infinite components that is not all zero."""
    infinite = F.lit(float("inf"))
    good = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < infinite))
    return F.coalesce(vector.isNotNull() & good & F.exists(vector, lambda x: x != 0), F.lit(False))


def matrix(lists, dtype=np.float32) -> np.ndarray:
    """Rows of equal length as one array."""
    rows = list(lists)
    return np.stack([np.asarray(r, dtype) for r in rows]) if rows else np.empty((0, 0), dtype)
