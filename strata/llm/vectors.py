"""Checks and transport of vectors shared by the two embedding operators."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F


def usable(v: Column) -> Column:
    """Not null, not empty, all components finite, not all zero."""
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return F.coalesce(v.isNotNull() & (F.size(v) > 0) & finite & F.exists(v, lambda x: x != 0), F.lit(False))


def matrix(lists: pa.Array) -> np.ndarray:
    """Lists of equal length without nulls as a float64 matrix."""
    flat = lists.flatten().to_numpy(zero_copy_only=False)
    return flat.astype(np.float64).reshape(len(lists), -1)
