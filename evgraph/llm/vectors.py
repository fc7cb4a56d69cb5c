"""Vectors of an Arrow list column as one numpy matrix."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F


def longest(vectors: DataFrame, column: str) -> int:
    """Entries of the longest vector; 0 where there is none."""
    size = F.coalesce(F.max(F.size(F.col(f"`{column}`"))), F.lit(0))
    return max(0, vectors.agg(size.alias("n")).first()["n"])


def matrix(column: pa.Array, dim: int) -> tuple[np.ndarray, np.ndarray]:
    """(rows, values) of the vectors whose entries are all finite numbers, as doubles.

    Null vectors and vectors with a null, infinite or NaN entry are left out; vectors shorter
    than ``dim`` end in zeros, so that no row is lost for its length."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    sizes = pc.list_value_length(column)
    there = pc.is_valid(sizes).to_numpy(zero_copy_only=False)
    sizes = pc.fill_null(sizes, 0).to_numpy(zero_copy_only=False).astype(np.int64)
    values = pc.fill_null(column.flatten().cast(pa.float64()), float("nan")).to_numpy(zero_copy_only=False)
    if len(column) and there.all() and (sizes == dim).all():
        full = values.reshape(len(column), dim)
    else:
        full = np.zeros((len(column), dim))
        row = np.repeat(np.arange(len(column)), sizes)
        place = np.arange(len(values)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        full[row, place] = values
    rows = np.flatnonzero(there & np.isfinite(full).all(axis=1))
    return rows, full[rows]
