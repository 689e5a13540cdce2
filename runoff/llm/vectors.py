"""Vector columns as numpy matrices."""
from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F


def usable(col: Column) -> Column:
    """Whether a vector is not null, not empty, not zero and has only finite components."""
    return F.coalesce(
        (F.size(col) > 0) & ~F.exists(col, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
        & F.exists(col, lambda x: x != 0), F.lit(False))


def matrix(column, dim: int) -> np.ndarray:
    """A list column (no nulls, all of length ``dim``) as a double matrix."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)


def by_length(column):
    """Yields (length, row numbers, matrix) for the lengths in a list column."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    lengths = np.diff(column.offsets.to_numpy())
    for d in np.unique(lengths):
        rows = np.flatnonzero(lengths == d)
        yield int(d), rows, matrix(column.take(pa.array(rows)), int(d))


def rotation(dim: int, seed: int) -> np.ndarray:
    """A random orthogonal matrix, the same everywhere."""
    q, r = np.linalg.qr(np.random.Generator(np.random.PCG64(seed)).standard_normal((dim, dim)))
    return q * np.sign(np.diag(r))
