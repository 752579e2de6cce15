"""Nearest vectors, analogies, similarity figures of all pairs in closed form and of given pairs."""

from __future__ import annotations

from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpuskit.functions import vectors as vc
from corpuskit.operators.lowrank import product_matrix
from corpuskit.operators.numbering import dense_ids
from corpuskit.session import cut_lineage

QUERY_ROWS, TABLE_ROWS = 1_024, 8_192  # rows of the two blocks that one task compares


def nearest(embeddings: DataFrame, query: list[float], k: int = 5, exclude: tuple[int, ...] = ()) -> DataFrame:
    """The ``k`` vectors most similar to one query: ``(id, sim)``, a top-k without a full sort."""
    rows = embeddings.where(~F.col("id").isin(list(exclude))) if exclude else embeddings
    target = F.array(*[F.lit(float(x)) for x in query])
    sim = vc.cosine(vc.as_double(F.col("vec")), target)
    return rows.select("id", sim.alias("sim")).orderBy(F.desc("sim"), "id").limit(k)


def nearest_to_each(
    queries: DataFrame, embeddings: DataFrame, k: int = 5,
    query_rows: int = QUERY_ROWS, table_rows: int = TABLE_ROWS,
) -> DataFrame:
    """The ``k`` nearest vectors of every query ``(query_id, vec, exclude array<bigint>)``.

    A stated set of queries against all rows, in blocks: both sides are dealt to
    blocks of bounded size by a hash, one task compares two blocks by a matrix
    product and sends ``k`` rows per query on.
    """
    asked = queries.select("query_id", vc.as_double(F.col("vec")).alias("asked"), "exclude")
    known = embeddings.select(F.col("id").cast("bigint").alias("id"), vc.as_double(F.col("vec")).alias("vec"))
    q_blocks = max(1, ceil(asked.count() / query_rows))
    t_blocks = max(1, ceil(known.count() / table_rows))

    def every(n: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    left = asked.withColumn("q", F.pmod(F.xxhash64("query_id"), F.lit(q_blocks)).cast("int")).withColumn("t", every(t_blocks))
    right = known.withColumn("t", F.pmod(F.xxhash64("id"), F.lit(t_blocks)).cast("int")).withColumn("q", every(q_blocks))

    def compare(some: pa.Table, block: pa.Table) -> pa.Table:
        names = ("query_id", "id", "sim")
        if not some.num_rows or not block.num_rows:
            return pa.table([pa.array([], t) for t in (pa.int64(), pa.int64(), pa.float64())], names=names)
        ids = block.column("id").to_numpy()
        vectors = vc.unit_rows(vc.as_matrix(block.column("vec").combine_chunks()), vc.COSINE_FLOOR)
        sims = vc.unit_rows(vc.as_matrix(some.column("asked").combine_chunks()), vc.COSINE_FLOOR) @ vectors.T
        skipped = some.column("exclude").combine_chunks()
        row = np.repeat(np.arange(len(skipped)), skipped.value_lengths().to_numpy(zero_copy_only=False))
        order = np.argsort(ids, kind="stable")
        skip = skipped.flatten().to_numpy(zero_copy_only=False)
        low, high = (np.searchsorted(ids, skip, side, sorter=order) for side in ("left", "right"))
        for r, a, b in zip(row, low, high):
            sims[r, order[a:b]] = -np.inf
        # Everything down to the k-th best value, ties included; then the first k by id.
        if sims.shape[1] > k:
            least = np.partition(sims, sims.shape[1] - k, axis=1)[:, [-k]]
            r, c = np.nonzero((sims >= least) & np.isfinite(sims))
        else:
            r, c = np.nonzero(np.isfinite(sims))
        best = np.lexsort((ids[c], -sims[r, c], r))
        r, c = r[best], c[best]
        place = np.arange(len(r)) - np.searchsorted(r, r)
        r, c = r[place < k], c[place < k]
        return pa.table([pa.array(x) for x in (some.column("query_id").to_numpy()[r], ids[c], sims[r, c])], names=names)

    found = left.groupBy("q", "t").cogroup(right.groupBy("q", "t")).applyInArrow(
        compare, "query_id bigint, id bigint, sim double"
    )
    place = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("sim"), "id"))
    return found.withColumn("place", place).where(F.col("place") <= k)


def similar_words(embeddings: DataFrame, words: list[str], k: int = 5) -> DataFrame:
    """``(word, token, sim, place)`` for known words; unknown ones give no rows.

    ``embeddings`` holds ``(id, token, vec)``; a word is left out of its own list by id.
    """
    queries = embeddings.where(F.col("token").isin(words)).select(
        F.col("id").cast("bigint").alias("query_id"), "vec",
        F.array(F.col("id").cast("bigint")).alias("exclude"),
    )
    found = nearest_to_each(queries, embeddings, k)
    return _with_tokens(found, embeddings, words)


def _with_tokens(found: DataFrame, embeddings: DataFrame, words: list[str]) -> DataFrame:
    asked = embeddings.where(F.col("token").isin(words)).select(
        F.col("id").cast("bigint").alias("query_id"), F.col("token").alias("word")
    )
    names = embeddings.select(F.col("id").cast("bigint").alias("id"), "token")
    return found.join(names, "id").join(asked, "query_id").select("word", "token", "sim", "place")


def analogies(embeddings: DataFrame, asked: DataFrame, k: int = 5) -> DataFrame:
    """For ids ``(query_id, a, b, c)``: the ``k`` nearest to ``b - a + c`` without a, b and c.

    Questions with an unknown id give no rows.
    """
    def side(name: str) -> DataFrame:
        return embeddings.select(
            F.col("id").cast("bigint").alias(name), vc.as_double(F.col("vec")).alias(f"vec_{name}")
        )

    full = asked.join(side("a"), "a").join(side("b"), "b").join(side("c"), "c")
    target = vc.add(vc.subtract(F.col("vec_b"), F.col("vec_a")), F.col("vec_c"))
    queries = full.select(
        "query_id", target.alias("vec"),
        F.array(*[F.col(c).cast("bigint") for c in "abc"]).alias("exclude"),
    )
    return nearest_to_each(queries, embeddings, k)


def word_analogy(embeddings: DataFrame, a: str, b: str, c: str, k: int = 5) -> DataFrame:
    """``(token, sim, place)`` for "a is to b as c is to …"; empty if a word is unknown."""
    ids = {r["token"]: r["id"] for r in embeddings.where(F.col("token").isin([a, b, c])).select("token", "id").collect()}
    rows = [(0, *(int(ids[w]) for w in (a, b, c)))] if {a, b, c} <= set(ids) else []
    asked = embeddings.sparkSession.createDataFrame(rows, "query_id bigint, a bigint, b bigint, c bigint")
    found = analogies(embeddings, asked, k)
    names = embeddings.select(F.col("id").cast("bigint").alias("id"), "token")
    return found.join(names, "id").select("token", "sim", "place")


# --- all pairs in closed form -------------------------------------------------------------


def unit_vectors(embeddings: DataFrame) -> DataFrame:
    return embeddings.select(
        F.col("id").cast("bigint").alias("id"), vc.normalize(vc.as_double(F.col("vec"))).alias("vec")
    )


def vector_sum(units: DataFrame, dim: int) -> list[float]:
    sums = units.agg(*[F.sum(F.col("vec")[i]).alias(f"s{i}") for i in range(dim)]).first()
    return [x or 0.0 for x in sums]


def cosine_moments(embeddings: DataFrame) -> DataFrame:
    """One row ``(n, mean, std)``: the cosine of all pairs of rows, without building a pair.

    With unit vectors u and their sum s, the cosines of all pairs add up to
    (|s|^2 - sum |u|^2) / 2 and their squares to (|U'U|^2 - sum |u|^4) / 2.
    """
    units = unit_vectors(embeddings)
    size = F.pow(vc.norm(F.col("vec")), F.lit(2))
    rows, dim, own, own_square = units.agg(F.count("*"), F.max(F.size("vec")), F.sum(size), F.sum(size * size)).first()
    n = rows * (rows - 1) // 2
    mean = std = None
    if n:
        total = (sum(x * x for x in vector_sum(units, dim)) - own) / 2
        squares = (float((product_matrix(units, dim) ** 2).sum()) - own_square) / 2
        mean = total / n
        std = (max(0.0, squares - n * mean * mean) / (n - 1)) ** 0.5 if n > 1 else None
    return embeddings.sparkSession.createDataFrame([(n, mean, std)], "n bigint, mean double, std double")


def cosine_means(embeddings: DataFrame) -> DataFrame:
    """``(id, n, mean)``: mean cosine of each vector to all others, (u . s - |u|^2) / (rows - 1)."""
    units = unit_vectors(embeddings)
    rows, dim = units.agg(F.count("*"), F.max(F.size("vec"))).first()
    total = F.array(*[F.lit(x) for x in vector_sum(units, dim or 0)]).cast("array<double>")
    u = F.col("vec")
    mean = F.try_divide(vc.dot(u, total) - vc.dot(u, u), F.lit(rows - 1))
    return units.select("id", F.lit(rows - 1).cast("bigint").alias("n"), mean.alias("mean"))


# --- given pairs --------------------------------------------------------------------------


METRICS = {"cosine": lambda a, b: vc.dot(vc.normalize(a), vc.normalize(b)), "euclidean": vc.euclidean}


def pair_values(embeddings: DataFrame, pairs: DataFrame, metric: str = "cosine") -> DataFrame:
    """``(i, j, value)`` for the pairs of ids ``(i, j)`` that are both in the table.

    Which pairs to compare is for the caller to say: the square of a table is
    never built.
    """
    def side(name: str) -> DataFrame:
        return embeddings.select(F.col("id").cast("bigint").alias(name), vc.as_double(F.col("vec")).alias(f"_{name}"))

    found = pairs.select("i", "j").join(side("i"), "i").join(side("j"), "j")
    return found.select("i", "j", METRICS[metric](F.col("_i"), F.col("_j")).alias("value"))


def by_vector(values: DataFrame) -> DataFrame:
    """``(id, n, mean, min, max)`` of the pairs each vector stands in."""
    rows = values.select(F.explode(F.array("i", "j")).alias("id"), "value")
    return rows.groupBy("id").agg(
        F.count("*").alias("n"), F.avg("value").alias("mean"), F.min("value").alias("min"), F.max("value").alias("max")
    )


def distribution(values: DataFrame) -> DataFrame:
    """One row ``(n, mean, std, min, max, median)``; std is the sample one, the median the lower one.

    The median is the row of that number in a range partitioned order, so no task
    sorts all values.
    """
    numbered = cut_lineage(dense_ids(values.select("value"), "value", id_type="bigint"))
    n, mean, std, low, high = numbered.agg(
        F.count("*"), F.avg("value"), F.stddev_samp("value"), F.min("value"), F.max("value")
    ).first()
    row = numbered.where(F.col("id") == (n - 1) // 2).select("value").first()
    return values.sparkSession.createDataFrame(
        [(n, mean, std if n > 1 else None, low, high, row and row[0])],
        "n bigint, mean double, std double, min double, max double, median double",
    )


def histogram(values: DataFrame, bins: int = 20) -> DataFrame:
    """``(bin, n)`` between the smallest and the largest value; the top edge belongs to the last bin."""
    low, high = values.agg(F.min("value"), F.max("value")).first()
    span = (high or 0.0) - (low or 0.0)
    at = F.least(F.floor((F.col("value") - F.lit(low)) / F.lit(span) * bins), F.lit(bins - 1)) if span > 0 else F.lit(0)
    return values.groupBy(at.cast("int").alias("bin")).agg(F.count("*").alias("n"))


def shades(values: DataFrame) -> DataFrame:
    """``(i, j, sim, band, step)``: given similarities with their shades for display."""
    sim = F.col("value")
    return values.select(
        "i", "j", sim.alias("sim"), vc.similarity_band(sim).alias("band"), vc.similarity_step(sim).alias("step")
    )


def norm_mean(embeddings: DataFrame) -> DataFrame:
    return embeddings.agg(F.avg(vc.norm(vc.as_double(F.col("vec")))).alias("norm_mean"))


def compare_kinds(embeddings: DataFrame) -> DataFrame:
    """Dense vectors against one-hot ones over the same ids: size, similarity, share of zeros.

    Different one-hot vectors are orthogonal, so their figures follow from the ids.
    """
    stats = cosine_moments(embeddings).first()
    vec = vc.as_double(F.col("vec"))
    sizes = embeddings.agg(
        F.max(F.size("vec")).alias("dim"),
        (F.sum(F.size(F.filter(vec, lambda x: x == 0))) / F.sum(F.size("vec"))).alias("zero_share"),
    )
    dense = sizes.select(
        F.lit("dense").alias("kind"), F.col("dim").cast("bigint").alias("dim"),
        F.lit(stats["mean"]).cast("double").alias("mean"),
        F.lit(stats["std"]).cast("double").alias("std"), "zero_share",
    )
    n = F.col("n")
    per_id = embeddings.groupBy("id").agg(F.count(F.lit(1)).alias("copies"))
    # Pairs of equal ids have similarity one, all others zero.
    pairs = per_id.agg(
        F.count(F.lit(1)).alias("n"), F.sum("copies").alias("rows"),
        F.sum(F.col("copies") * (F.col("copies") - 1) / 2).alias("same"),
    ).withColumn("pairs", F.col("rows") * (F.col("rows") - 1) / 2)
    mean = F.try_divide("same", "pairs")
    spread_ = F.sqrt(F.try_divide(F.col("same") * F.pow(1 - mean, F.lit(2)) + (F.col("pairs") - F.col("same")) * F.pow(mean, F.lit(2)), F.col("pairs") - 1))
    one_hot = pairs.select(
        F.lit("one-hot").alias("kind"), n.alias("dim"), mean.alias("mean"), spread_.alias("std"),
        ((n - 1) / n).alias("zero_share"),
    )
    return dense.unionByName(one_hot)
