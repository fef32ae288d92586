"""What the vector operators share: which vectors take part, and Arrow lists as matrices."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F


def as_doubles(name: str) -> Column:
    return F.col(name).cast("array<double>")


def is_finite(vector: Column) -> Column:
    """True for a vector that is there and holds no null, NaN or infinite component."""
    limit = F.lit(float("inf"))
    good = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < limit))
    return F.coalesce(good, F.lit(False))


def matrix(column: pa.ChunkedArray | pa.Array, dim: int) -> np.ndarray:
    """The rows of a list column whose lists all have ``dim`` elements."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), dim)


def unit_rows(rows: np.ndarray) -> np.ndarray:
    """Rows of length one; each is scaled by its largest component first, so nothing overflows."""
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.sqrt((rows * rows).sum(axis=1, keepdims=True))
