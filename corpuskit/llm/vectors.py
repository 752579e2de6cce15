"""What the vector operators share."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def is_valid(vector: Column) -> Column:
    """True for vectors of one component or more, all of them finite numbers."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vector.isNotNull() & (F.size(vector) > 0) & ~bad


def valid_vectors(table: DataFrame, vec_id: str, vector: str) -> DataFrame:
    """``(vec_id, vec)`` as doubles, of valid vectors with an id."""
    vec = F.col(vector).cast("array<double>")
    return table.where(F.col(vec_id).isNotNull() & is_valid(vec)).select(
        F.col(vec_id).cast("bigint").alias("vec_id"), vec.alias("vec")
    )


def by_length(column: pa.Array | pa.ChunkedArray) -> list[tuple[np.ndarray, np.ndarray]]:
    """Rows and matrix of the vectors of each length; lengths ascending."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    sizes = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy(zero_copy_only=False)
    out = []
    for size in np.unique(sizes):
        rows = np.flatnonzero(sizes == size)
        picked = flat if len(rows) == len(sizes) else flat[np.repeat(sizes == size, sizes)]
        out.append((rows, picked.reshape(len(rows), size)))
    return out
