"""Exact top-k inner products by the threshold algorithm over sorted per-dimension lists."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpuskit.llm.vectors import by_length, valid_vectors

QUERY_BLOCK = 1_024
DATA_BLOCK = 8_192
FIRST_DEPTH = 32
RESULT = "query_id bigint, vec_id bigint, score bigint"


class SortedLists:
    """One block of integer vectors with a list per dimension, sorted by component."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray) -> None:
        self.ids, self.vectors = ids, vectors
        self.lists = np.argsort(vectors, axis=0, kind="stable").T.copy()

    def top(self, query_id: int, query: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and scores of the ``k`` best rows other than the query's own, ties to the smaller id.

        Sorted access reads every list from the end that helps the score, to growing
        depths.  Rows met for the first time are scored in full (random access).  No
        row still unseen can score more than the components at the present depth
        give together; once that is below the k-th score, the rest is left unread.
        An equal bound goes on, as an unseen row could tie with a smaller id.
        """
        rows = len(self.ids)
        used = np.flatnonzero(query)
        ahead = query[used] > 0
        unseen = self.ids != query_id
        found, scores = np.zeros(0, np.int64), np.zeros(0, np.int64)
        done, depth = 0, FIRST_DEPTH
        while done < rows and unseen.any():
            depth = min(depth, rows)
            near = np.concatenate([self.lists[used[~ahead], done:depth].ravel(), self.lists[used[ahead], rows - depth : rows - done].ravel()])
            if not len(used):  # an all-zero query: every score is 0 and every row a tie
                near, depth = np.arange(rows), rows
            fresh = np.unique(near[unseen[near]])
            unseen[fresh] = False
            found = np.concatenate([found, fresh])
            scores = np.concatenate([scores, self.vectors[fresh] @ query])
            if len(found) > k:
                best = np.lexsort((self.ids[found], -scores))[:k]
                found, scores = found[best], scores[best]
            at = np.where(ahead, rows - depth, depth - 1)
            bound = int((query[used] * self.vectors[self.lists[used, at], used]).sum())
            if len(found) >= k and scores.min() > bound:
                break
            done, depth = depth, 2 * depth
        return self.ids[found], scores


def as_integers(vector: Column, scale: int) -> Column:
    return F.transform(vector, lambda x: F.floor(x * F.lit(float(scale))))


def top_k(
    table: DataFrame,
    queries: Column,
    k: int = 10,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    scale: int = 1_024,
    query_block: int = QUERY_BLOCK,
    data_block: int = DATA_BLOCK,
) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: for the rows where ``queries`` holds, the ``k`` best others.

    ``queries`` is a condition on ``vec_id``.  Components become floor(scale * x);
    the score is their integer inner product, exact in 64 bits (larger sums wrap around).  Queries and rows are
    dealt to blocks of bounded size by a hash; each pair of blocks is one task's
    work and sends at most ``k`` rows per query on.  Null and empty vectors, ones
    with null or non-finite components and rows without an id take no part, vectors
    of another length than the query's are no candidates.  A repeated id that is a
    query is asked once per row; its own rows are no candidates.
    """
    rows = valid_vectors(table, vec_id, vector).select("vec_id", as_integers(F.col("vec"), scale).alias("vec"))
    asked = rows.where(queries)
    # Two counts decide the grid.
    n_rows, n_asked = rows.agg(F.count("*"), F.count_if(queries)).first()
    grid, blocks = max(1, -(-n_asked // query_block)), max(1, -(-n_rows // data_block))
    deal = F.xxhash64("vec_id", "vec")
    left = asked.withColumn("_q", F.pmod(deal, F.lit(grid)).cast("int")).withColumn("_d", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    right = rows.withColumn("_d", F.pmod(deal, F.lit(blocks)).cast("int")).withColumn("_q", F.explode(F.sequence(F.lit(0), F.lit(grid - 1))))

    def search(asked_rows: pa.Table, block: pa.Table) -> pa.Table:
        out = []
        lists = {}
        ids = block.column("vec_id").to_numpy()
        if block.num_rows:
            for at, matrix in by_length(block.column("vec")):
                lists[matrix.shape[1]] = SortedLists(ids[at], matrix)
        if asked_rows.num_rows and lists:
            names = asked_rows.column("vec_id").to_numpy()
            for at, matrix in by_length(asked_rows.column("vec")):
                if matrix.shape[1] in lists:
                    for name, query in zip(names[at].tolist(), matrix):
                        found, scores = lists[matrix.shape[1]].top(name, query, k)
                        out.append((np.full(len(found), name), found, scores))
        columns = [np.concatenate(c) for c in zip(*out)] if out else [np.zeros(0, np.int64)] * 3
        return pa.table([pa.array(c, pa.int64()) for c in columns], names=["query_id", "vec_id", "score"])

    near = left.groupBy("_q", "_d").cogroup(right.groupBy("_q", "_d")).applyInArrow(search, RESULT)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = near.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
