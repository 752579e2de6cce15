"""What several of these operators share: sorted runs in tasks, and connected components."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpuskit.llm.token_ids import array_groups
from corpuskit.session import cut_lineage


def with_columns(
    docs: DataFrame,
    text: str,
    added: dict[str, str],
    function: Callable[..., list[pa.Array]],
    extra: tuple[Column, ...] = (),
    size: int = 1_000_000,
) -> DataFrame:
    """All columns of ``docs`` and the ``added`` ones (name to type), made from slices of texts.

    ``function`` gets about ``size`` bytes of texts at a time, whole texts always,
    and the same rows of the ``extra`` columns.  Columns of the added names are
    replaced.  Inside, columns have numbers for names, so that none can clash, and
    the text travels once.
    """
    names = [c for c in docs.columns if c not in added]
    plain = [f"c{n}" for n in range(len(names))]
    fed = [F.col(f"`{name}`").alias(c) for name, c in zip(names, plain)]
    if text not in names:
        fed.append(F.col(f"`{text}`").alias("text"))
    at = names.index(text) if text in names else len(names)
    n_fed = len(fed)
    table = docs.select(*fed, *[c.alias(f"x{n}") for n, c in enumerate(extra)])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            done = 0
            for texts in array_groups(batch.column(at), size):
                part = batch.slice(done, len(texts))
                done += len(texts)
                made = function(texts, *part.columns[n_fed:])
                yield pa.RecordBatch.from_arrays([*part.columns[: len(names)], *made], names=[*plain, *added])

    schema = [f"{c} {table.schema[c].dataType.simpleString()}" for c in plain] + [f"{n} {t}" for n, t in added.items()]
    out = table.mapInArrow(rows, ", ".join(schema))
    return out.select(*[F.col(c).alias(name) for name, c in zip(names, plain)], *added)


def whole_runs(batches: Iterator[pa.RecordBatch], keys: list[str], rows: int = 50_000) -> Iterator[pa.Table]:
    """Tables of about ``rows`` sorted rows, cut only where the key columns change.

    Memory is bounded by ``rows`` plus the longest run; callers bound the runs.
    """
    held: list[pa.Table] = []
    size = 0
    for batch in batches:
        held.append(pa.Table.from_batches([batch]))
        size += batch.num_rows
        if size < rows:
            continue
        table = pa.concat_tables(held).combine_chunks()
        changes = np.flatnonzero(starts_of(table, keys))
        cut = int(changes[-1])
        if cut:
            yield table.slice(0, cut)
        held, size = [table.slice(cut)], table.num_rows - cut
    if size:
        yield pa.concat_tables(held).combine_chunks()


def starts_of(table: pa.Table, keys: list[str]) -> np.ndarray:
    """True where a run of equal keys begins."""
    new = np.zeros(table.num_rows, bool)
    if table.num_rows:
        new[0] = True
    for key in keys:
        values = table.column(key).to_numpy()
        new[1:] |= values[1:] != values[:-1]
    return new


def bounded_cells(members: DataFrame, keys: list[str], most: int) -> DataFrame:
    """Split large groups so that every pair of their rows still meets in one cell.

    ``members`` gets ``_a`` and ``_b``, the cell, and ``_own``, the row's chunk.  A
    group of at most ``most`` rows is the cell (0, 0).  A larger one is dealt to
    c = ceil(n / most) chunks by a hash of the whole row, and each row goes to the c
    cells that hold its chunk, so a cell has about 2 * ``most`` rows however large
    the group is.  Two rows of one chunk meet in all of its cells; those of two
    chunks in one.
    """
    large = members.groupBy(*keys).agg(F.count("*").alias("_n")).where(F.col("_n") > most)
    large = cut_lineage(large.withColumn("_c", F.ceil(F.col("_n") / most).cast("int")).drop("_n"))
    if large.isEmpty():
        return members.withColumns({"_a": F.lit(0), "_b": F.lit(0), "_own": F.lit(0)})
    own = F.pmod(F.xxhash64(*members.columns), F.col("_c")).cast("int")
    split = members.join(large, keys, "left").withColumn("_c", F.coalesce("_c", F.lit(1))).withColumn("_own", own)
    return (
        split.withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_c") - 1)))
        .withColumns({"_a": F.least("_own", "_other"), "_b": F.greatest("_own", "_other")})
        .drop("_c", "_other")
    )


def components(edges: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of ``edges`` (u, v): the smallest node of its component.

    Large-star and small-star steps alternate until the links stand still.  The
    smallest neighbour is found by partial aggregates, and the links are joined
    back to it, so no neighbourhood is gathered; every round is written to the
    checkpoint folder.
    """
    links = cut_lineage(
        edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    )
    seen = None
    while True:
        both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        # Large star: larger neighbours go to the smallest node of the neighbourhood.
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        # Small star: a node and its smaller neighbours go to the smallest of them.
        small = large.join(low, "u").select(
            F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e")
        )
        links = cut_lineage(small.select("e.u", "e.v").where("u <> v").distinct())
        state = links.agg(
            F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")), F.bit_xor(F.xxhash64("v", "u"))
        ).first()
        if state == seen:
            break
        seen = state
    roots = links.groupBy("u").agg(F.min("v").alias("root")).withColumnRenamed("u", "node")
    return roots.unionByName(links.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


def run_pairs(begin: np.ndarray, most: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs (i, i + k) inside runs of at most ``most`` rows, k = 1, 2, …"""
    run = np.cumsum(begin) - 1
    sizes = np.bincount(run) if len(run) else np.zeros(0, int)
    rows = np.flatnonzero(sizes[run] <= most)
    end = np.cumsum(sizes)[run]
    k = 1
    while len(rows):
        rows = rows[rows + k < end[rows]]
        if len(rows):
            yield rows, rows + k
        k += 1


def large_runs(begin: np.ndarray, most: int) -> Iterator[slice]:
    """The runs of more than ``most`` rows."""
    starts = np.append(np.flatnonzero(begin), len(begin))
    for a, b in zip(starts[:-1], starts[1:]):
        if b - a > most:
            yield slice(int(a), int(b))
