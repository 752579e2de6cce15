"""Near-duplicate documents by SimHash fingerprints and pivot distance tables."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpuskit.llm.common import bounded_cells, components, large_runs, run_pairs, starts_of, whole_runs
from corpuskit.llm.text_figures import pieces
from corpuskit.operators.lookup import lookup_join
from corpuskit.session import cut_lineage

SEED = 42
PIVOTS = 32
BLOCKS = 6  # with at most 4 differing bits, two of six blocks of bits agree
CELL = 4_096
SMALL_RUN = 48

# For each byte value eight one-byte counters in one word, the first for the highest bit.
LANES = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).view(np.uint64).ravel()


def fingerprint(text: str | None, shingle: int = 4, seed: int = SEED) -> int:
    """SimHash of one text as a signed 64-bit number; 0 if it has no word.

    A long text is worked through in pieces, which hand their last words on.
    """
    carried: list[bytes] = []
    shingles, set_bits = 0, np.zeros(64, np.int64)
    for piece in pieces(text or ""):
        words = carried + piece.encode("utf-8", "replace").lower().split()
        carried = words
        if len(words) >= shingle:
            shingles += len(words) - shingle + 1
            set_bits += bit_counts(words, shingle, seed)
            carried = words[len(words) - shingle + 1 :]
    if not shingles:
        whole = xxhash.xxh64_digest(b" ".join(carried), seed) if carried else bytes(8)
        return int.from_bytes(whole, "big", signed=True)
    return int.from_bytes(np.packbits(2 * set_bits > shingles).tobytes(), "big", signed=True)


def bit_counts(words: list[bytes], shingle: int, seed: int) -> np.ndarray:
    """How many shingles set each bit of their hash, the highest bit first."""
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[: len(words) - shingle] + 1)).tolist()
    digest = xxhash.xxh64_digest
    raw = b"".join([digest(joined[a:b], seed) for a, b in zip(starts, ends[shingle - 1 :].tolist())])
    lanes = LANES[np.frombuffer(raw, np.uint8)].reshape(-1, 8)
    # A one-byte counter holds 255 shingles at most.
    sums = np.add.reduceat(lanes, np.arange(0, len(lanes), 255), axis=0)
    return sums.view(np.uint8).reshape(len(sums), 64).sum(axis=0, dtype=np.int64)


def fingerprints(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", shingle: int = 4) -> DataFrame:
    """``(doc_id, text_hash, fp)`` for every row; a null or blank text has fingerprint 0."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = pa.array([fingerprint(t.as_py(), shingle) for t in batch.column(2)], pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], found], names=["doc_id", "text_hash", "fp"])

    source = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.xxhash64(F.col(text)).alias("text_hash"), F.col(text).alias("text"))
    return source.mapInArrow(rows, "doc_id bigint, text_hash bigint, fp bigint")


def pivot_table(prints: np.ndarray, pivots: int = PIVOTS) -> np.ndarray:
    """Hamming distances of each fingerprint to the reference fingerprints.

    The references are the multiples of the golden ratio in 64 bits, XOR-folded:
    any number of well spread codes from one rule, the same on every machine.
    """
    with np.errstate(over="ignore"):
        codes = np.arange(1, pivots + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    codes ^= codes >> np.uint64(29)
    return np.bitwise_count(prints.astype(np.uint64)[:, None] ^ codes[None, :]).astype(np.int8)


def near(a: np.ndarray, b: np.ndarray, da: np.ndarray, db: np.ndarray, distance: int) -> np.ndarray:
    """Which pairs are within ``distance``: pivot coordinates first, then the exact distance.

    |d(x, p) - d(y, p)| <= d(x, y) for every pivot p, so a pair with one larger
    coordinate difference is discarded unseen.
    """
    left = np.flatnonzero(np.abs(da - db).max(axis=1) <= distance)
    return left[np.bitwise_count(a[left] ^ b[left]) <= distance]


def spanning_links(codes: np.ndarray, table: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect what is connected within one cell, found breadth first.

    A row is compared only with rows that no earlier one has reached, so a group
    of near copies costs about its size, not its square.
    """
    left = np.arange(len(codes))
    us, vs = [], []
    while len(left):
        queue, left = [left[0]], left[1:]
        while queue and len(left):
            x = queue.pop()
            same = np.full(len(left), x)
            hit = near(codes[same], codes[left], table[same], table[left], distance)
            if len(hit):
                found = left[hit]
                us.append(np.full(len(found), x))
                vs.append(found)
                queue.extend(found.tolist())
                left = np.delete(left, hit)
    none = np.zeros(0, np.int64)
    return (np.concatenate(us), np.concatenate(vs)) if us else (none, none)


def block_keys(fp: Column, blocks: int, agree: int) -> Column:
    """One (table, bits) per choice of ``agree`` blocks."""
    edges = np.linspace(0, 64, blocks + 1).round().astype(int)
    masks = [((1 << int(b)) - (1 << int(a))) for a, b in zip(edges[:-1], edges[1:])]
    keys = []
    for n, chosen in enumerate(combinations(masks, agree)):
        mask = sum(chosen)
        keys.append(F.struct(F.lit(n).alias("t"), fp.bitwiseAND(F.lit(mask - (1 << 64) if mask >> 63 else mask)).alias("key")))
    return F.array(*keys)


def links(classes: DataFrame, distance: int = 4, blocks: int = BLOCKS, cell: int = CELL) -> DataFrame:
    """``(u, v)``: links between distinct fingerprints that join all which belong together.

    Two fingerprints within ``distance`` agree on at least ``blocks - distance`` of
    ``blocks`` blocks of bits, so they meet in one of the tables; none is lost.
    Cells of a table are bounded (``bounded_cells``).  In a cell the pivot table
    discards pairs and the exact distance decides.  For larger collections take
    more blocks: the keys grow longer and the tables more.
    """
    tables = classes.select("fp", F.explode(block_keys(F.col("fp"), blocks, blocks - distance)).alias("k"))
    cells = bounded_cells(tables.select("k.t", "k.key", "fp"), ["t", "key"], cell)
    keys = ["t", "key", "_a", "_b"]

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_runs(batches, keys):
            begin = starts_of(table, keys)
            alone = begin & np.append(begin[1:], True)
            rows = np.flatnonzero(~alone)
            if not len(rows):
                continue
            begin = begin[rows]
            codes = table.column("fp").to_numpy()[rows].view(np.uint64)
            pivots = pivot_table(codes)
            us, vs = [], []
            for i, j in run_pairs(begin, SMALL_RUN):
                hit = near(codes[i], codes[j], pivots[i], pivots[j], distance)
                us.append(codes[i[hit]])
                vs.append(codes[j[hit]])
            for run in large_runs(begin, SMALL_RUN):
                u, v = spanning_links(codes[run], pivots[run], distance)
                us.append(codes[run][u])
                vs.append(codes[run][v])
            if us:
                u, v = np.concatenate(us).view(np.int64), np.concatenate(vs).view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], names=["u", "v"])

    dealt = cells.repartition(*keys).sortWithinPartitions(*keys)
    return dealt.mapInArrow(compare, "u bigint, v bigint")


def rooted_classes(prints: DataFrame, distance: int, blocks: int = BLOCKS) -> DataFrame:
    """``(fp, root, component_id)`` of every distinct fingerprint.

    Only linked fingerprints are joined to the name of their root, by a lookup that
    splits the roots of very large groups; the others name themselves.
    """
    classes = cut_lineage(prints.groupBy("fp").agg(F.min("doc_id").alias("first")))
    roots = cut_lineage(components(links(classes, distance, blocks)).withColumnRenamed("node", "fp"))
    linked = cut_lineage(roots.join(classes, "fp").select("fp", "root", "first"))
    names = linked.groupBy("root").agg(F.min("first").alias("component_id"))
    named = lookup_join(linked, names, "root", "inner").select("fp", "root", "component_id")
    alone = classes.join(roots, "fp", "left_anti").select("fp", F.col("fp").alias("root"), F.col("first").alias("component_id"))
    return cut_lineage(named.unionByName(alone))


def near_duplicates(
    docs: DataFrame, text: str = "text", doc_id: str = "doc_id", shingle: int = 4, distance: int = 4, blocks: int = BLOCKS
) -> DataFrame:
    """``(doc_id, fp, component_id)``, one row per row of ``docs``.

    Equal fingerprints are one class before any comparison, so thousands of copies
    cost one row.  Null and blank texts share fingerprint 0 and are linked like any
    other.  A row with a null id keeps its null id and never names a component that
    holds another id; repeated ids give repeated rows; an empty table gives none.
    """
    prints = cut_lineage(fingerprints(docs, text, doc_id, shingle))
    return prints.join(rooted_classes(prints, distance, blocks), "fp").select("doc_id", "fp", "component_id")


def one_of_each(
    docs: DataFrame, text: str = "text", doc_id: str = "doc_id", shingle: int = 4, distance: int = 4, blocks: int = BLOCKS
) -> DataFrame:
    """The rows of ``docs`` with all their columns, one for each group of near copies.

    The smallest id stays; of several texts under that id, the one with the smaller
    hash; of equal rows, one.  A group of null ids keeps one row.
    """
    prints = cut_lineage(fingerprints(docs, text, doc_id, shingle))
    named = prints.join(rooted_classes(prints, distance, blocks), "fp").where(F.col("doc_id").eqNullSafe(F.col("component_id")))
    chosen = named.groupBy("root", "doc_id").agg(F.min("text_hash").alias("text_hash"))
    stay = cut_lineage(
        named.join(chosen.select("root", "text_hash"), ["root", "text_hash"]).groupBy("root", "doc_id", "text_hash").agg(F.count("*").alias("n"))
    )
    # Columns have numbers for names here, so that none can clash.
    plain = [f"c{i}" for i in range(len(docs.columns))]
    rows = docs.select(*[F.col(f"`{name}`").alias(c) for name, c in zip(docs.columns, plain)])
    key, body = (plain[docs.columns.index(name)] for name in (doc_id, text))
    hashed = rows.withColumn("_hash", F.xxhash64(body))
    same = F.col(key).cast("bigint").eqNullSafe(F.col("_id")) & (F.col("_hash") == F.col("_text"))
    keys = stay.select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_text"), "n")
    single = hashed.join(keys.where("n = 1"), same, "left_semi")
    # Rows that stand in the table several times are rare; only they are compared as rows.
    several = hashed.join(keys.where("n > 1"), same, "left_semi").dropDuplicates([key, "_hash"])
    kept = single.unionByName(several)
    return kept.select(*[F.col(c).alias(name) for name, c in zip(docs.columns, plain)])
