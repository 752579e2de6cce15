"""Column expressions over vectors held as arrays, and matrices of Arrow batches."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from corpuskit.functions.arrays import let

# Floors used when dividing by a norm.
NORMALIZE_FLOOR = 1e-12
COSINE_FLOOR = 1e-8


def as_double(vec: Column) -> Column:
    return vec.cast("array<double>")


def total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda acc, x: acc + x)


def dot(a: Column, b: Column) -> Column:
    return total(F.zip_with(a, b, lambda x, y: x * y))


def norm(vec: Column) -> Column:
    return F.sqrt(F.aggregate(vec, F.lit(0.0), lambda acc, x: acc + x * x))


def normalize(vec: Column) -> Column:
    """Unit length; a zero vector stays zero."""
    length = F.greatest(norm(vec), F.lit(NORMALIZE_FLOOR))
    return let(length, lambda size: F.transform(vec, lambda x: x / size))


def cosine(a: Column, b: Column) -> Column:
    return dot(a, b) / (
        F.greatest(norm(a), F.lit(COSINE_FLOOR)) * F.greatest(norm(b), F.lit(COSINE_FLOOR))
    )


def euclidean(a: Column, b: Column) -> Column:
    return F.sqrt(total(F.zip_with(a, b, lambda x, y: (x - y) * (x - y))))


def add(a: Column, b: Column) -> Column:
    return F.zip_with(a, b, lambda x, y: x + y)


def subtract(a: Column, b: Column) -> Column:
    return F.zip_with(a, b, lambda x, y: x - y)


def mix(old: Column, new: Column, rate: float) -> Column:
    """Moving average step ``(1 - rate) * old + rate * new``."""
    return F.zip_with(old, new, lambda t, s: t * F.lit(1.0 - rate) + s * F.lit(rate))


def similarity_band(sim: Column) -> Column:
    """Shade 4 (above .9) to 0 (at most .3)."""
    return (
        F.when(sim > 0.9, 4).when(sim > 0.7, 3).when(sim > 0.5, 2).when(sim > 0.3, 1).otherwise(0)
    )


def similarity_step(sim: Column, steps: int = 9) -> Column:
    """Index into a gradient of ``steps`` shades, clamped to its ends."""
    last = steps - 1
    return F.least(F.greatest(F.floor(sim * last), F.lit(0)), F.lit(last)).cast("int")


def as_matrix(lists: pa.Array) -> np.ndarray:
    flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(lists), -1 if len(lists) else 0)


def unit_rows(m: np.ndarray, floor: float) -> np.ndarray:
    return m / np.maximum(np.linalg.norm(m, axis=1, keepdims=True), floor)
