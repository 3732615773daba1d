"""Columns of vectors: which take part, and their rows as a matrix."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F


def finite(name: str) -> Column:
    """True for vectors that are there and hold finite numbers only."""
    bad = lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf"))
    return F.col(name).isNotNull() & ~F.exists(F.col(name), lambda c: F.coalesce(bad(c.cast("double")), F.lit(True)))


def matrix(column: pa.Array, dims: int, fill: int = 0) -> np.ndarray:
    """The integer vectors of a column as rows of `dims` entries; shorter ones end with `fill`."""
    sizes = column.value_lengths().to_numpy(zero_copy_only=False)
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    if (sizes == dims).all():
        return flat.reshape(len(column), dims)
    out = np.full((len(column), dims), fill, np.int64)
    ends = np.cumsum(sizes)
    for k, (end, size) in enumerate(zip(ends, sizes)):
        out[k, :size] = flat[end - size : end]
    return out
