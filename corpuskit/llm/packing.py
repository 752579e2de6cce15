"""Packing documents into fixed windows by best-fit decreasing."""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpuskit.llm import token_ids
from corpuskit.session import cut_lineage

WINDOW = 2_048
END = 1
PIECE_SCHEMA = (
    "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, _part int, _nth bigint"
)
PLAN_SCHEMA = "length bigint, _from bigint, _to bigint, _window bigint, _offset bigint, _each bigint"


class CapacityTree:
    """Segment tree over remaining capacities: the tightest one that is open and large enough."""

    def __init__(self, most: int) -> None:
        self.leaves = 1 << most.bit_length()
        self.open = [False] * (2 * self.leaves)

    def mark(self, capacity: int, is_open: bool) -> None:
        node = capacity + self.leaves
        self.open[node] = is_open
        while node > 1:
            node //= 2
            self.open[node] = self.open[2 * node] or self.open[2 * node + 1]

    def tightest(self, size: int) -> int | None:
        """The smallest open capacity of at least ``size``."""
        node = size + self.leaves
        if self.open[node]:
            return size
        while node > 1:
            if node % 2 == 0 and self.open[node + 1]:
                node += 1
                while node < self.leaves:
                    node = 2 * node if self.open[2 * node] else 2 * node + 1
                return node - self.leaves
            node //= 2
        return None


def best_fit(histogram: dict[int, int], window: int) -> list[tuple[int, int, int, int, int, int]]:
    """Best-fit decreasing over counts of pieces by length.

    Pieces of one length are interchangeable and windows with one remaining
    capacity are too, so both are handled as ranges, with the outcome of placing
    one piece after another.  Returns (length, from, to, window, offset, each):
    pieces ``from`` <= n < ``to`` of that length fill windows from ``window`` on,
    ``each`` of them a window, from ``offset``.  At most ``window`` lengths and
    capacities exist, whatever the number of documents.
    """
    plan, tree = [], CapacityTree(window)
    groups: dict[int, list[tuple[int, int]]] = defaultdict(list)  # capacity -> (first window, windows)
    windows = 0

    def keep(capacity: int, first: int, count: int) -> None:
        if capacity and count:
            groups[capacity].append((first, count))
            tree.mark(capacity, True)

    for size in sorted(histogram, reverse=True):
        done, total = 0, histogram[size]
        while done < total:
            capacity = tree.tightest(size)
            if capacity is None:
                capacity = window
                each = window // size
                first, count = windows, -(-(total - done) // each)
                windows += count
            else:
                first, count = groups[capacity].pop()
                if not groups[capacity]:
                    tree.mark(capacity, False)
                each = capacity // size
            full = min(count, (total - done) // each)
            rest = min(each - 1, total - done - full * each) if full < count else 0
            used = full * each + rest
            plan.append((size, done, done + used, first, window - capacity, each))
            done += used
            keep(capacity - each * size, first, full)
            if rest:
                keep(capacity - rest * size, first + full, 1)
                full += 1
            keep(capacity, first + full, count - full)
    return plan


def window_pieces(
    docs: DataFrame,
    text: str = "text",
    doc_id: str = "doc_id",
    path: str | None = None,
    drops_space: bool = True,
    end: int = END,
    window: int = WINDOW,
) -> DataFrame:
    """Every document's ids cut into full windows and a rest, with the checksum of each piece.

    ``_nth`` numbers the pieces of one length inside the partition ``_part``.
    """
    path = path or token_ids.default_path("word_bpe_49k.json")

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, seen = TaskContext.get().partitionId(), defaultdict(int)
        encode = token_ids.encoder(path, drops_space).encode
        for batch in batches:
            keys = iter(batch.column(0).to_pylist())
            for texts in token_ids.array_groups(batch.column(1)):
                out = []
                for ids, key in zip(encode(texts, end), keys):
                    raw, total = memoryview(ids.astype("<u4").tobytes()), len(ids)
                    for start in range(0, total, window):
                        size = min(window, total - start)
                        check = zlib.crc32(raw[4 * start : 4 * (start + size)])
                        out.append((key, start, size, check, total, part, seen[size]))
                        seen[size] += 1
                columns = list(zip(*out))
                types = [pa.int64()] * 5 + [pa.int32(), pa.int64()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(columns, types)],
                    names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "_part", "_nth"],
                )

    source = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    return source.mapInArrow(rows, PIECE_SCHEMA)


def pack(pieces: DataFrame, window: int = WINDOW) -> DataFrame:
    """Place pieces (``window_pieces``) with best-fit decreasing over the whole table.

    The driver sees one count per length, ``window`` numbers at most, and plans
    ranges.  Where a piece stands among all of its length comes from its number
    in its partition and a running count of the partitions, so no length, however
    frequent, meets in one task.
    """
    pieces = cut_lineage(pieces)
    counts = cut_lineage(pieces.groupBy("length", "_part").agg(F.count("*").alias("n")))
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    plan = pieces.sparkSession.createDataFrame(best_fit(histogram, window), PLAN_SCHEMA)
    before = Window.partitionBy("length").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    bases = counts.select("length", "_part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_base"))
    ranked = pieces.join(bases, ["length", "_part"]).withColumn("_rank", F.col("_base") + F.col("_nth"))
    # The plan is bounded by the number of lengths and capacities, not by the data.
    placed = ranked.join(
        F.broadcast(plan.withColumnRenamed("length", "_size")),
        (F.col("length") == F.col("_size")) & (F.col("_rank") >= F.col("_from")) & (F.col("_rank") < F.col("_to")),
    )
    nth = F.col("_rank") - F.col("_from")
    return placed.select(
        "doc_id",
        "start",
        "length",
        "ids_crc32",
        "doc_tokens",
        (F.col("_window") + F.floor(nth / F.col("_each"))).alias("sequence_id"),
        (F.col("_offset") + nth % F.col("_each") * F.col("length")).alias("offset"),
    )


def packed(
    docs: DataFrame,
    text: str = "text",
    doc_id: str = "doc_id",
    path: str | None = None,
    drops_space: bool = True,
    end: int = END,
    window: int = WINDOW,
) -> DataFrame:
    """``(doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset)`` per piece.

    Null and empty texts are the end id alone.  A null id stays null, repeated
    rows are packed each, an empty table gives no piece.  Ties between windows of
    one capacity do not change the number of windows.
    """
    return pack(window_pieces(docs, text, doc_id, path, drops_space, end, window), window)
