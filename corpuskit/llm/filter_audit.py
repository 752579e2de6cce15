"""Audit of filters that overlap: what each removes in every order, from counts per set of failed filters."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import permutations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpuskit.llm import text_figures as figures
from corpuskit.llm.token_ids import array_groups
from corpuskit.operators.lookup import lookup_join
from corpuskit.session import cut_lineage

LETTERS = "ABCDE"
MARKS = "#$%&*|"
PROBES = 3
CELLS_PER_TEXT = 16
SKETCH_BYTES = 64 * 2**20  # most bytes of the sketch: 2**28 cells
BLOCK_CELLS = 1 << 19
MIXERS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)  # odd constants of a multiplicative hash


def text_mask(text: str) -> int:
    """Bits of the filters A to D that a text fails."""
    words, distinct = figures.words_and_distinct(text)
    mask = 1 * (words < 200) | 2 * (100 * distinct < 50 * words)
    mask |= 4 * (100 * figures.capitals(text) > 2 * len(text))
    return mask | 8 * any(c in text for c in MARKS)


def masks(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", part: str = "source") -> DataFrame:
    """``(doc_id, part, mask, hash)`` of every document, written once; texts are read here and left behind."""
    whole = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    rows = docs.select(
        F.col(f"`{doc_id}`").alias("doc_id"),
        F.coalesce(F.col(f"`{part}`").cast("string"), F.lit("")).alias("part"),
        F.xxhash64(whole).alias("hash"),
        whole.alias("text"),
    )

    def judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [text_mask(t) for texts in array_groups(batch.column(3), 1_000_000) for t in texts.to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(found, pa.int32())], names=["doc_id", "part", "hash", "mask"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    return cut_lineage(rows.mapInArrow(judged, f"doc_id {kind}, part string, hash bigint, mask int"))


class Sketch:
    """A counting Bloom filter whose counters stop at two: one bit for "met", one for "met again"."""

    def __init__(self, bits: int, met: np.ndarray, again: np.ndarray) -> None:
        self.bits, self.met, self.again = bits, met, again

    def may_repeat(self, hashes: np.ndarray) -> np.ndarray:
        """False for texts met once for sure."""
        sure = np.zeros(len(hashes), bool)
        for cells in cells_of(hashes, self.bits):
            byte, bit = cells >> np.uint64(3), np.uint8(1) << (cells & np.uint64(7)).astype(np.uint8)
            sure |= (self.again[byte] & bit) == 0
        return ~sure


def cells_of(hashes: np.ndarray, bits: int) -> Iterator[np.ndarray]:
    keys = hashes.view(np.uint64)
    for mixer in MIXERS[:PROBES]:
        with np.errstate(over="ignore"):
            mixed = (keys ^ (keys >> np.uint64(29))) * np.uint64(mixer)
        yield mixed >> np.uint64(64 - bits)


def sketch_of(rows: DataFrame, most_bytes: int = SKETCH_BYTES) -> Sketch:
    """The merged sketch of all hashes of ``rows``.

    Each task counts its own cells, at most two for each, and cells meet by block; so a text that makes up
    a third of the table costs a task three cells.  The table of cells grows with the number of rows,
    sixteen a row, up to ``most_bytes``, the proven bound of what the driver and the tasks hold.  Beyond
    ``2 * most_bytes`` rows it fills up and clears fewer texts; results stay the same.
    """
    wanted = max(BLOCK_CELLS, CELLS_PER_TEXT * rows.count())
    bits = min(int(np.ceil(np.log2(wanted))), int(np.log2(4 * most_bytes)))
    shift = np.uint64(int(np.log2(BLOCK_CELLS)))

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            held.append(np.concatenate(list(cells_of(batch.column(0).to_numpy(zero_copy_only=False), bits))))
            size += len(held[-1])
            if size > 2_000_000:
                yield from blocks(held)
                held, size = [], 0
        if held:
            yield from blocks(held)

    def blocks(held: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        cells, counts = np.unique(np.concatenate(held), return_counts=True)
        cells = np.concatenate([cells, cells[counts > 1]])
        cells.sort()
        block = cells >> shift
        cuts = np.append(np.flatnonzero(np.diff(block, prepend=block[:1] + np.uint64(1))), len(cells))
        inner = (cells & np.uint64(BLOCK_CELLS - 1)).astype(np.uint32)
        values = [inner[a:b].tobytes() for a, b in zip(cuts[:-1], cuts[1:])]
        yield pa.RecordBatch.from_pydict({"block": pa.array(block[cuts[:-1]].astype(np.int64)), "cells": pa.array(values, pa.binary())})

    def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, counts = None, np.zeros(BLOCK_CELLS, np.uint8)

        def packed() -> pa.RecordBatch:
            met, again = (np.packbits(counts >= k, bitorder="little").tobytes() for k in (1, 2))
            return pa.RecordBatch.from_pydict({"block": pa.array([now], pa.int64()), "met": pa.array([met], pa.binary()), "again": pa.array([again], pa.binary())})

        for batch in batches:
            for block, cells in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if block != now:
                    if now is not None:
                        yield packed()
                    now, counts[:] = block, 0
                got = np.bincount(np.frombuffer(cells, np.uint32), minlength=BLOCK_CELLS).clip(max=2)
                np.minimum(counts + got.astype(np.uint8), 2, out=counts)
        if now is not None:
            yield packed()

    partials = rows.select("hash").mapInArrow(partial, "block bigint, cells binary")
    whole = partials.repartition("block").sortWithinPartitions("block").mapInArrow(merged, "block bigint, met binary, again binary")
    met, again = (np.zeros((1 << bits) // 8, np.uint8) for _ in range(2))
    step = BLOCK_CELLS // 8
    for row in whole.toLocalIterator():
        at = row["block"] * step
        met[at : at + step] = np.frombuffer(row["met"], np.uint8)
        again[at : at + step] = np.frombuffer(row["again"], np.uint8)
    return Sketch(bits, met, again)


def tester(docs: DataFrame, sketch: Sketch) -> Callable[[Column], Column]:
    """The sketch as a column function of a hash."""
    sent = docs.sparkSession.sparkContext.broadcast(sketch)

    @F.pandas_udf("boolean")
    def may_repeat(hashes: pd.Series) -> pd.Series:
        return pd.Series(sent.value.may_repeat(hashes.to_numpy(np.int64)))

    return may_repeat


def failures(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", part: str = "source", most_bytes: int = SKETCH_BYTES) -> DataFrame:
    """``(doc_id, part, mask, n)``: documents with the filters they fail; ``n`` rows were alike.

    A: under 200 words.  B: under half of the words distinct.  C: over 2 % of the characters are A-Z.  D:
    holds one of ``#$%&*|``.  E: equals the text of a smaller id anywhere in the table.

    Texts whose cells in the sketch were met once occur once; they take no part in the shuffle.  The others
    are grouped by their whole text, after partial aggregation, for the smallest id.  A null text is empty,
    a null part the empty string.  A null id is smaller than none and has no smaller one, and rows with
    equal id and text do not fail each other.  No documents give no rows.
    """
    rows = masks(docs, doc_id, text, part)
    may_repeat = tester(docs, sketch_of(rows, most_bytes))
    again = may_repeat(F.col("hash")) & F.col("doc_id").isNotNull()
    tested = cut_lineage(rows.withColumn("again", again))
    whole = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
    suspects = whole.where(F.col("doc_id").isNotNull()).where(may_repeat(F.xxhash64("text")))
    firsts = suspects.groupBy("text").agg(F.min("doc_id").alias("doc_id"))
    firsts = cut_lineage(firsts.select("doc_id", F.xxhash64("text").alias("hash"), F.lit(True).alias("first")))
    alike = tested.where("again").groupBy("doc_id", "hash", "part", "mask").agg(F.count("*").alias("n"))
    marked = alike.join(firsts.distinct(), ["doc_id", "hash"], "left")
    mask = F.col("mask") + F.when(F.col("first"), 0).otherwise(16)
    unique = tested.where(~F.col("again")).select("doc_id", "part", "mask", F.lit(1).cast("bigint").alias("n"))
    return marked.select("doc_id", "part", mask.alias("mask"), "n").unionByName(unique)


def mask_counts(failed: DataFrame, labels: DataFrame) -> DataFrame:
    """``(part, mask, n, good, toxic)``: rows per set of failed filters; these counts add up over tables.

    A document is good (toxic) if some label of its id has quality 1 (toxic 1).
    """
    known = labels.where(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(
        F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic")
    )
    rows = lookup_join(failed, known, "doc_id")
    sums = [F.sum(F.when(F.col(c) == 1, F.col("n")).otherwise(0)).alias(c) for c in ("good", "toxic")]
    return rows.groupBy("part", "mask").agg(F.sum("n").alias("n"), *sums)


def interactions(counts: DataFrame, letters: str = LETTERS) -> DataFrame:
    """One row per part, order of the filters and step, from at most 2 ** filters counts a part.

    ``kept``: pass this and all earlier filters; ``removed``: fail this one and none before; ``redundant``:
    fail this one, removed before; ``unique_fails``: fail this one alone; ``good_lost``, ``toxic_lost``: of
    those removed; ``shapley``: ``removed`` of the filter summed over all orders.
    """
    lists = counts.groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("counts"))
    orders = F.array(*[F.lit("".join(p)) for p in permutations(letters)])
    rows = lists.withColumn("filter_order", F.explode(orders)).withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(len(letters)))))

    def bits(of: Column) -> Column:
        total = F.lit(0)
        for n, letter in enumerate(letters):
            total = total + F.when(F.contains(of, F.lit(letter)), 1 << n).otherwise(0)
        return total

    rows = rows.withColumns(
        {"own": bits(F.substring("filter_order", F.col("step"), F.lit(1))), "before": bits(F.left("filter_order", F.col("step") - 1))}
    )

    def total(field: str, condition: Callable[[Column], Column]) -> Column:
        chosen = F.filter("counts", lambda c: condition(c["mask"]))
        return F.aggregate(chosen, F.lit(0).cast("bigint"), lambda s, c: s + c[field])

    own, before = F.col("own"), F.col("before")
    fails = lambda m: m.bitwiseAND(own) != 0
    gone = lambda m: m.bitwiseAND(before) != 0
    figures_ = {
        "kept": total("n", lambda m: ~fails(m) & ~gone(m)),
        "removed": total("n", lambda m: fails(m) & ~gone(m)),
        "redundant": total("n", lambda m: fails(m) & gone(m)),
        "unique_fails": total("n", lambda m: m == own),
        "good_lost": total("good", lambda m: fails(m) & ~gone(m)),
        "toxic_lost": total("toxic", lambda m: fails(m) & ~gone(m)),
    }
    out = rows.select("part", "filter_order", "step", "own", *[c.alias(n) for n, c in figures_.items()])
    sums = out.groupBy("part", "own").agg(F.sum("removed").alias("shapley"))
    return out.join(sums, ["part", "own"]).drop("own")


def audit(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", part: str = "source") -> DataFrame:
    """All interactions of the five filters on ``docs``; see ``failures`` and ``interactions``."""
    counts = cut_lineage(mask_counts(failures(docs, doc_id, text, part), labels))
    return interactions(counts)
