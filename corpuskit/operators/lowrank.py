"""Low-rank factors of a tall vector table and row-wise low-rank updates."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpuskit.functions.subwords import as_lists
from corpuskit.functions.vectors import as_matrix

MAX_DIM = 4096  # the d x d product matrix is gathered on the driver


@dataclass
class Factors:
    """``W ~ U diag(sigma) Vt`` with ``U`` as a table ``(id, u)``."""

    u: DataFrame
    sigma: np.ndarray
    vt: np.ndarray


def product_matrix(table: DataFrame, dim: int) -> np.ndarray:
    """``W'W``: every Arrow batch gives one partial matrix, Spark adds them up."""
    if dim > MAX_DIM:
        raise ValueError(f"vectors may have at most {MAX_DIM} entries")

    def run(data: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((dim, dim))
        for record in data:
            if record.num_rows:
                m = as_matrix(record.column("vec"))
                total += m.T @ m
        i, j = np.triu_indices(dim)
        yield pa.RecordBatch.from_arrays(
            [pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32)), pa.array(total[i, j])],
            names=["i", "j", "value"],
        )

    parts = table.select("vec").mapInArrow(run, "i int, j int, value double")
    rows = parts.groupBy("i", "j").agg(F.sum("value").alias("value")).toArrow()
    i, j, value = (rows.column(c).to_numpy() for c in ("i", "j", "value"))
    out = np.zeros((dim, dim))
    out[i, j] = value
    out[j, i] = value
    return out


def truncated_svd(table: DataFrame, rank: int) -> Factors:
    """Leading ``min(rank, n, d)`` factors; the largest entry of each right vector is positive."""
    n, dim = table.agg(F.count(F.lit(1)), F.max(F.size("vec"))).first()
    r = min(rank, n, dim or 0)
    values, directions = np.linalg.eigh(product_matrix(table, dim))
    order = np.argsort(values)[::-1][:r]
    sigma = np.sqrt(np.maximum(values[order], 0.0))
    v = directions[:, order]
    v = v * np.sign(v[np.abs(v).argmax(axis=0), np.arange(r)])
    scale = np.divide(1.0, sigma, out=np.zeros_like(sigma), where=sigma > 0)
    shared = table.sparkSession.sparkContext.broadcast(v * scale)

    def run(data: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for record in data:
            if record.num_rows:
                u = as_matrix(record.column("vec")) @ shared.value
                yield pa.RecordBatch.from_arrays(
                    [record.column("id").cast(pa.int64()), as_lists(pa.array(u.ravel()), np.full(len(u), u.shape[1]))],
                    names=["id", "u"],
                )

    u = table.select("id", "vec").mapInArrow(run, "id bigint, u array<double>")
    return Factors(u, sigma, v.T)


def low_rank_update(table: DataFrame, factors: Factors, mixing: np.ndarray, alpha: float = 1.0) -> DataFrame:
    """``(id, vec)`` with ``alpha U diag(sigma) R Vt`` added to every row, in one pass.

    A row of ``U diag(sigma)`` is that row of ``W`` times ``V``, so no join with ``U`` is needed.
    """
    step = alpha * factors.vt.T @ mixing @ factors.vt
    shared = table.sparkSession.sparkContext.broadcast(step)

    def run(data: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for record in data:
            if record.num_rows:
                w = as_matrix(record.column("vec"))
                moved = w + w @ shared.value
                yield pa.RecordBatch.from_arrays(
                    [record.column("id").cast(pa.int64()), as_lists(pa.array(moved.ravel()), np.full(len(w), w.shape[1]))],
                    names=["id", "vec"],
                )

    return table.select("id", "vec").mapInArrow(run, "id bigint, vec array<double>")
