"""Vectors: similarity, nearest neighbours, whole-table summaries, low rank."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from corpuskit.functions import vectors as vc
from corpuskit.operators import losses as ls
from corpuskit.operators import lowrank as lr
from corpuskit.operators import similarity as sm
from corpuskit.operators.embedding_training import random_unit_vectors
from corpuskit.plans.catalog import embeddings, query, rounded

E = "e as (select vec_id as id, 'v' || vec_id as token, cast(embedding as double[]) as v, label from embeddings)"


def dot_sql(a: str, b: str) -> str:
    return f"list_dot_product({a}, {b})"


def cosine_sql(a: str, b: str, floor: str = "1e-8") -> str:
    return (
        f"({dot_sql(a, b)} / (greatest(sqrt({dot_sql(a, a)}), {floor}) * greatest(sqrt({dot_sql(b, b)}), {floor})))"
    )


def named(spark, sf):
    return embeddings(spark, sf).withColumn("token", F.concat(F.lit("v"), F.col("id").cast("string")))


@query("normalized_vectors", f"""with {E}, u as (select id, list_transform(v, lambda x: x / greatest(sqrt({dot_sql('v', 'v')}), 1e-12)) as u from e)
select id, round(list_sum(u), 6) as total, round(list_max(u), 6) as largest, round(sqrt({dot_sql('u', 'u')}), 6) as norm from u""")
def normalized_vectors(spark, sf):
    unit = embeddings(spark, sf).select("id", vc.normalize(vc.as_double(F.col("vec"))).alias("u"))
    u = F.col("u")
    return unit.select(
        "id", rounded(vc.total(u)).alias("total"), rounded(F.array_max(u)).alias("largest"), rounded(vc.norm(u)).alias("norm")
    )


@query("cosine_of_neighbours", f"with {E} select a.id, round({cosine_sql('a.v', 'b.v')}, 6) + 0.0 as sim from e a join e b on b.id = a.id + 1")
def cosine_of_neighbours(spark, sf):
    a = embeddings(spark, sf)
    b = a.select((F.col("id") - 1).alias("id"), vc.as_double(F.col("vec")).alias("next"))
    return a.join(b, "id").select("id", rounded(vc.cosine(vc.as_double(F.col("vec")), F.col("next"))).alias("sim"))


@query("nearest_vectors", f"""with {E} select e.id, round({cosine_sql('e.v', 'q.v')}, 6) as sim
from e, (select v from e where id = 0) q where e.id not in (0, 3) order by {cosine_sql('e.v', 'q.v')} desc, e.id limit 5""")
def nearest_vectors(spark, sf):
    e = embeddings(spark, sf)
    wanted = e.where("id = 0").select("vec").first()[0]
    return sm.nearest(e, wanted, 5, exclude=(0, 3)).select("id", rounded(F.col("sim")).alias("sim"))


def ranked_sql(source: str, skip: str, k: int) -> str:
    return f"""sims as (select q.word, e.id, e.token, {cosine_sql('e.v', 'q.v')} as sim from e, {source} q where {skip}),
placed as (select *, row_number() over (partition by word order by sim desc, id) as place from sims)"""


@query("similar_words", f"""with {E}, q as (select token as word, id as qid, v from e where token in ('v0', 'v7', 'v42')),
{ranked_sql('q', 'e.id <> q.qid', 5)} select word, token, round(sim, 6) as sim, cast(place as integer) as place from placed where place <= 5""")
def similar_words(spark, sf):
    found = sm.similar_words(named(spark, sf), ["v0", "v7", "v42", "absent"], 5)
    return found.withColumn("sim", rounded(F.col("sim")))


@query("nearest_to_each", f"""with {E}, q as (select id as word, id as qid, v from e where id % 50 = 0),
{ranked_sql('q', 'e.id <> q.qid', 3)} select word as query_id, id, round(sim, 6) as sim, cast(place as integer) as place from placed where place <= 3""")
def nearest_to_each(spark, sf):
    """Every fiftieth vector against all others."""
    e = embeddings(spark, sf)
    queries = e.where("id % 50 = 0").select(F.col("id").alias("query_id"), "vec", F.array("id").alias("exclude"))
    return sm.nearest_to_each(queries, e, 3).withColumn("sim", rounded(F.col("sim")))


@query("word_analogy", f"""with {E}, q as (select 0 as word, list_transform(list_zip(b.v, a.v, c.v), lambda t: t[1] - t[2] + t[3]) as v
  from e a, e b, e c where a.token = 'v1' and b.token = 'v2' and c.token = 'v3'),
{ranked_sql('q', "e.token not in ('v1', 'v2', 'v3')", 5)} select token, round(sim, 6) as sim, cast(place as integer) as place from placed where place <= 5""")
def word_analogy(spark, sf):
    return sm.word_analogy(named(spark, sf), "v1", "v2", "v3", 5).withColumn("sim", rounded(F.col("sim")))


@query("analogies", f"""with {E}, q as (select a.id as word, [a.id, b.id, c.id] as skip, list_transform(list_zip(b.v, a.v, c.v), lambda t: t[1] - t[2] + t[3]) as v
  from e a join e b on b.id = a.id + 1 join e c on c.id = a.id + 2 where a.id % 50 = 0),
{ranked_sql('q', 'not list_contains(q.skip, e.id)', 1)} select word as query_id, id, round(sim, 6) as sim from placed where place <= 1""")
def analogies(spark, sf):
    """A question for every fiftieth vector: it and the next two."""
    e = embeddings(spark, sf)
    asked = e.where("id % 50 = 0").select(F.col("id").alias("query_id"), F.col("id").alias("a"), (F.col("id") + 1).alias("b"), (F.col("id") + 2).alias("c"))
    return sm.analogies(e, asked, 1).select("query_id", "id", rounded(F.col("sim")).alias("sim"))


UNIT = "u as (select id, list_transform(v, lambda x: x / greatest(sqrt(list_dot_product(v, v)), 1e-12)) as u from e)"
ALL_SIMS = f"{E}, {UNIT}, sims as (select a.id as i, b.id as j, list_dot_product(a.u, b.u) as s from u a join u b on a.id < b.id)"


@query("similarity_moments", f"with {ALL_SIMS} select count(*) as n, round(avg(s), 6) + 0.0 as mean, round(stddev_samp(s), 6) as std from sims")
def similarity_moments(spark, sf):
    """Over all pairs, in closed form."""
    rows = sm.cosine_moments(embeddings(spark, sf))
    return rows.select("n", rounded(F.col("mean")).alias("mean"), rounded(F.col("std")).alias("std"))


@query("similarity_means", f"""with {ALL_SIMS} select id, count(*) as n, round(avg(s), 6) + 0.0 as mean
from (select i as id, s from sims union all select j, s from sims) group by id""")
def similarity_means(spark, sf):
    """Of every vector to all others, in closed form."""
    rows = sm.cosine_means(embeddings(spark, sf))
    return rows.withColumn("mean", rounded(F.col("mean")))


# The pairs compared below: every vector and the next twelve ids.
NEAR = 12
SIMS = f"{E}, {UNIT}, sims as (select a.id as i, b.id as j, list_dot_product(a.u, b.u) as s from u a join u b on b.id > a.id and b.id <= a.id + {NEAR})"
DISTANCES = f"{E}, sims as (select a.id as i, b.id as j, list_distance(a.v, b.v) as s from e a join e b on b.id > a.id and b.id <= a.id + {NEAR})"
BY_VECTOR = """select id, count(*) as n, round(avg(s), 6) + 0.0 as mean, round(min(s), 6) + 0.0 as min, round(max(s), 6) + 0.0 as max
from (select i as id, s from sims union all select j, s from sims) group by id"""


def near_values(spark, sf, metric="cosine"):
    e = embeddings(spark, sf)
    pairs = e.select(F.col("id").alias("i"), F.explode(F.sequence(F.col("id") + 1, F.col("id") + NEAR)).alias("j"))
    return sm.pair_values(e, pairs, metric)


def by_vector(spark, sf, metric):
    rows = sm.by_vector(near_values(spark, sf, metric))
    return rows.withColumns({c: rounded(F.col(c)) for c in ("mean", "min", "max")})


@query("similarity_by_vector", f"with {SIMS} {BY_VECTOR}")
def similarity_by_vector(spark, sf):
    return by_vector(spark, sf, "cosine")


@query("distance_by_vector", f"with {DISTANCES} {BY_VECTOR}")
def distance_by_vector(spark, sf):
    return by_vector(spark, sf, "euclidean")


SPREAD = """select count(*) as n, round(avg(s), 6) + 0.0 as mean, round(stddev_samp(s), 6) as std, round(min(s), 6) as min,
 round(max(s), 6) as max, round(percentile_disc(0.5) within group (order by s), 6) + 0.0 as median from sims"""


def spread_of(spark, sf, metric):
    return sm.distribution(near_values(spark, sf, metric)).withColumns(
        {c: rounded(F.col(c)) for c in ("mean", "std", "min", "max", "median")}
    )


@query("similarity_distribution", f"with {SIMS} {SPREAD}")
def similarity_distribution(spark, sf):
    return spread_of(spark, sf, "cosine")


@query("distance_distribution", f"with {DISTANCES} {SPREAD}")
def distance_distribution(spark, sf):
    return spread_of(spark, sf, "euclidean")


@query("similarity_histogram", f"""with {SIMS}, edge as (select min(s) as lo, max(s) as hi from sims)
select cast(least(floor((s - lo) / (hi - lo) * 20), 19) as integer) as bin, count(*) as n from sims, edge group by 1""")
def similarity_histogram(spark, sf):
    return sm.histogram(near_values(spark, sf), 20)


@query("similarity_heatmap", f"""with {SIMS}
select i, j, round(s, 6) + 0.0 as sim, case when s > 0.9 then 4 when s > 0.7 then 3 when s > 0.5 then 2 when s > 0.3 then 1 else 0 end as band,
 cast(least(greatest(floor(s * 8), 0), 8) as integer) as step from sims""")
def similarity_heatmap(spark, sf):
    """The shades of the similarities beside the diagonal."""
    return sm.shades(near_values(spark, sf)).withColumn("sim", rounded(F.col("sim")))


@query("compared_vector_kinds", f"""with {ALL_SIMS}
select 'dense' as kind, cast(64 as bigint) as dim, round(avg(s), 6) + 0.0 as mean, round(stddev_samp(s), 6) as std,
 (select round(avg(case when x = 0 then 1.0 else 0.0 end), 6) from (select unnest(v) as x from e)) as zero_share from sims
union all select 'one-hot', (select count(*) from e), 0, 0, (select round(1 - 1 / count(*), 6) from e)""")
def compared_vector_kinds(spark, sf):
    kinds = sm.compare_kinds(embeddings(spark, sf))
    return kinds.withColumns({c: rounded(F.col(c)) for c in ("mean", "std", "zero_share")})


@query("mean_norm", f"with {E} select round(avg(sqrt({dot_sql('v', 'v')})), 6) as norm_mean from e")
def mean_norm(spark, sf):
    return sm.norm_mean(embeddings(spark, sf)).select(rounded(F.col("norm_mean")).alias("norm_mean"))


@query("moving_average", f"""with {E}, s as (select id, list_transform(list_zip(v, list_reverse(v)), lambda t: t[1] * 0.95 + t[2] * 0.05) as m from e)
select id, round(m[1], 6) + 0.0 as first, round(list_sum(m), 6) + 0.0 as total from s""")
def moving_average(spark, sf):
    """Vectors moved a little towards their own reversal."""
    e = embeddings(spark, sf).select("id", "vec")
    student = e.select("id", F.reverse("vec").alias("vec"))
    moved = ls.moving_average(e, student, 0.05)
    return moved.select("id", rounded(F.col("vec")[0]).alias("first"), rounded(vc.total(F.col("vec"))).alias("total"))


def draw_sql(number):
    return f"(cast('0x' || left(md5(id || ':' || i || ':3:{number}'), 13) as bigint) + 1) / cast(4503599627370497 as double)"


@query("random_unit_vectors", f"""with n as (select vec_id as id, i, sqrt(-2 * ln({draw_sql(0).replace('id ||', 'vec_id ||')})) * cos(2 * pi() * {draw_sql(1).replace('id ||', 'vec_id ||')}) as x
  from embeddings, (select unnest(range(16)) as i))
select id, cast(1 as double) as norm, round(any_value(x) filter (i = 0) / sqrt(sum(x * x)), 6) + 0.0 as first,
  round(any_value(x) filter (i = 15) / sqrt(sum(x * x)), 6) + 0.0 as last from n group by id""")
def random_unit_vectors_query(spark, sf):
    drawn = random_unit_vectors(embeddings(spark, sf), 16, seed=3)
    vec = F.col("vec")
    return drawn.select(
        "id", rounded(vc.norm(vec)).alias("norm"), rounded(vec[0]).alias("first"), rounded(vec[15]).alias("last")
    )


@query("low_rank_factors")
def low_rank_factors(spark, sf):
    factors = lr.truncated_svd(embeddings(spark, sf), 4)
    return factors.u.select("id", *[rounded(F.col("u")[i]).alias(f"u{i}") for i in range(4)])


@query("low_rank_update")
def low_rank_update(spark, sf):
    table = embeddings(spark, sf)
    factors = lr.truncated_svd(table, 2)
    moved = lr.low_rank_update(table, factors, np.array([[0.5, 0.1], [0.0, 0.5]]), alpha=0.5)
    return moved.select("id", rounded(vc.norm(F.col("vec"))).alias("norm"))


# What the factors leave of the table and what they hold add up to the table, for the right factors only.
SQUARES = "select round(sum(list_dot_product(cast(embedding as double[]), cast(embedding as double[]))), 4) as total"


@query("low_rank_identity", f"{SQUARES}, 4 as columns from embeddings")
def low_rank_identity(spark, sf):
    """|W - U S Vt|^2 + |S|^2 = |W|^2, and the squares in the columns of U add up to their number."""
    e = embeddings(spark, sf)
    factors = lr.truncated_svd(e, 4)
    rebuilt = factors.sigma[:, None] * factors.vt
    rows = e.join(factors.u, "id")
    back = [F.array(*[F.lit(float(x)) for x in row]) for row in rebuilt]
    near = F.array_repeat(F.lit(0.0), e.select(F.max(F.size("vec"))).first()[0])
    for n, row in enumerate(back):
        entry = F.col("u")[n]
        near = vc.add(near, F.transform(row, lambda x: x * entry))
    rest = vc.subtract(vc.as_double(F.col("vec")), near)
    held = float((factors.sigma**2).sum())
    return rows.agg(
        F.round(F.sum(vc.dot(rest, rest)) + held, 4).alias("total"),
        F.round(F.sum(vc.dot(F.col("u"), F.col("u")))).cast("int").alias("columns"),
    )


@query("low_rank_removed", f"{SQUARES} from embeddings")
def low_rank_removed(spark, sf):
    """An update that takes the factors themselves away: what is left and the factors add up to the table."""
    e = embeddings(spark, sf)
    factors = lr.truncated_svd(e, 3)
    left = lr.low_rank_update(e, factors, -2.0 * np.eye(3), alpha=0.5)
    held = float((factors.sigma**2).sum())
    return left.agg(F.round(F.sum(vc.dot(F.col("vec"), F.col("vec"))) + held, 4).alias("total"))
