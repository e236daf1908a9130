"""Vector tables cut into bounded blocks, so that all-against-all work becomes tiles of two blocks."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F


def usable(vector: Column) -> Column:
    """True for vectors that are not null and hold neither null nor a non-finite component."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vector.isNotNull() & ~F.coalesce(bad, F.lit(True))


def block_count(rows: int, block_rows: int) -> int:
    return max(1, math.ceil(rows / block_rows))


def matrix(column: pa.ChunkedArray, dtype) -> np.ndarray:
    """Rows of a list column as a matrix; short rows are filled up with zeros."""
    lists = column.combine_chunks()
    lists = lists.chunk(0) if isinstance(lists, pa.ChunkedArray) else lists
    sizes = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    width = int(sizes.max()) if len(sizes) else 0
    values = lists.flatten().to_numpy(zero_copy_only=False).astype(dtype)
    if len(sizes) and (sizes == width).all():
        return values.reshape(len(sizes), width)
    out = np.zeros((len(sizes), width), dtype)
    out[np.arange(width)[None, :] < sizes[:, None]] = values
    return out
