"""Advantages and losses over tables derived from documents, conversations and vectors."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpuskit.config import Distillation, LossWeights
from corpuskit.functions import text as tx
from corpuskit.operators import losses as ls
from corpuskit.plans.catalog import WORDS, embeddings, query, rounded, table

# Samples: labelled documents grouped by source, rewarded for quality; the log
# probabilities follow from the text length by a fixed rule.
SAMPLES = """s as (select d.source as prompt_id, cast(d.doc_id as integer) as sample_id, d.doc_id as seq, cast(l.quality as double) as reward,
 -(n_chars % 97) / 50.0 as logp, -(n_chars % 89) / 50.0 as old_logp, -(n_chars % 83) / 50.0 as ref_logp
 from documents d join labels l on l.doc_id = d.doc_id)"""


def samples(spark, sf):
    docs = table(spark, sf, "documents", "doc_id", "source", "n_chars")
    labels = table(spark, sf, "labels", "doc_id", "quality")

    def rule(modulus):
        return -(F.col("n_chars") % modulus) / 50.0

    return docs.join(labels, "doc_id").select(
        F.col("source").alias("prompt_id"), F.col("doc_id").cast("int").alias("sample_id"), F.col("doc_id").alias("seq"),
        F.col("quality").cast("double").alias("reward"), rule(97).alias("logp"), rule(89).alias("old_logp"), rule(83).alias("ref_logp"),
    )


def advantage_sql(group: str, floor: str) -> str:
    guard = {"add": "(stddev_samp(reward) over w + 1e-8)", "clamp": "greatest(stddev_samp(reward) over w, 1e-8)"}[floor]
    # A group of one has no deviation.
    return f"case when count(*) over w < 2 then 0 else (reward - avg(reward) over w) / {guard} end as advantage"


def advantages_cte(floor: str) -> str:
    return f"{SAMPLES}, a as (select *, {advantage_sql('prompt_id', floor)} from s window w as (partition by prompt_id))"


SHOW_ADVANTAGE = "select prompt_id, sample_id, round(advantage, 5) + 0.0 as advantage from a"


def shown(rows):
    return rows.select("prompt_id", "sample_id", rounded(F.col("advantage"), 5).alias("advantage"))


@query("group_advantages", f"with {advantages_cte('add')} {SHOW_ADVANTAGE}")
def group_advantages(spark, sf):
    return shown(ls.group_advantages(samples(spark, sf)))


@query("clamped_advantages", f"with {advantages_cte('clamp')} {SHOW_ADVANTAGE}")
def clamped_advantages(spark, sf):
    return shown(ls.group_advantages(samples(spark, sf), floor="clamp"))


@query("consecutive_advantages", f"""with {SAMPLES}, n as (select *, (row_number() over (order by seq) - 1) // 4 as g from s),
a as (select prompt_id, sample_id, case when count(*) over w = 4 then (reward - avg(reward) over w) / (stddev_samp(reward) over w + 1e-8) else 0 end as advantage
 from n window w as (partition by g)) {SHOW_ADVANTAGE}""")
def consecutive_advantages(spark, sf):
    return shown(ls.consecutive_advantages(samples(spark, sf), 4))


TERM = "-least(exp(logp - old_logp) * advantage, least(greatest(exp(logp - old_logp), 0.8), 1.2) * advantage)"


@query("sequence_policy_loss", f"with {advantages_cte('clamp')} select round(avg({TERM}), 6) as policy_loss from a")
def sequence_policy_loss(spark, sf):
    rows = ls.group_advantages(samples(spark, sf), floor="clamp")
    return ls.sequence_policy_loss(rows).select(rounded(F.col("policy_loss")).alias("policy_loss"))


# Token rows: the words of every labelled document, each with made-up but fixed log probabilities.
TOKENS = f"""{advantages_cte('add')},
words as (select doc_id, unnest(l) as word, unnest(range(len(l))) as pos from (select doc_id, {WORDS} as l from documents)),
t as (select prompt_id, sample_id, pos, advantage, -(length(word) % 7) / 10.0 as logp, -((length(word) + pos) % 5) / 10.0 as old_logp,
 case when pos % 6 = 5 then 0 else 1 end as mask from a join words on words.doc_id = a.seq)"""


def token_rows(spark, sf):
    rows = ls.group_advantages(samples(spark, sf)).select("prompt_id", "sample_id", "seq", "advantage")
    docs = table(spark, sf, "documents", "doc_id", "text")
    words = docs.join(rows, docs.doc_id == rows.seq).select(
        "prompt_id", "sample_id", "advantage", F.posexplode(tx.words(F.col("text"))).alias("pos", "word")
    )
    n, pos = F.length("word"), F.col("pos")
    return words.select(
        "prompt_id", "sample_id", "pos", "advantage",
        (-(n % 7) / 10.0).alias("logp"), (-((n + pos) % 5) / 10.0).alias("old_logp"),
        F.when(pos % 6 == 5, 0).otherwise(1).alias("mask"),
    )


def policy_sql(term: str, mask: str) -> str:
    return f"""with {TOKENS} select round(sum({term} * {mask}) / sum({mask}), 6) + 0.0 as pg_loss, round(avg(exp(logp - old_logp)), 6) as mean_ratio,
 (select round(avg(advantage), 6) + 0.0 from a where seq in (select doc_id from words)) as mean_advantage from t"""


def rounded_all(df):
    return df.select(*[rounded(F.col(c)).alias(c) for c in df.columns])


@query("token_policy_loss", policy_sql(TERM, "mask"))
def token_policy_loss(spark, sf):
    return rounded_all(ls.token_policy_loss(token_rows(spark, sf)))


@query("unclipped_policy_loss", policy_sql("-(exp(logp - old_logp) * advantage)", "1"))
def unclipped_policy_loss(spark, sf):
    return rounded_all(ls.token_policy_loss(token_rows(spark, sf), clip=None, mask=None))


@query("step_metrics", f"""with {advantages_cte('clamp')},
m as (select avg({TERM}) as policy_loss, 0.04 * avg(logp - ref_logp) as kl_loss, avg(reward) as mean_reward, avg(advantage) as mean_advantage from a)
select round(policy_loss, 6) as policy_loss, round(kl_loss, 6) as kl_loss, round(policy_loss + kl_loss, 6) as total_loss,
 round(mean_reward, 6) as mean_reward, round(mean_advantage, 6) + 0.0 as mean_advantage from m""")
def step_metrics(spark, sf):
    return rounded_all(ls.step_metrics(samples(spark, sf), kl_weight=0.04))


# Logits: a vector as the student, the next one as the teacher.
LOGITS = """e as (select vec_id as id, list_transform(cast(embedding as double[]), lambda x: x * 10) as v, label from embeddings),
l as (select a.id, a.v as student, b.v as teacher, a.label, case when a.id % 5 = 0 then 0 else 1 end as mask from e a join e b on b.id = a.id + 1)"""


def lse_sql(x: str) -> str:
    return f"(list_max({x}) + ln(list_sum(list_transform({x}, lambda y: exp(y - list_max({x}))))))"


def soft_sql(x: str) -> str:
    return f"list_transform({x}, lambda z: z - {lse_sql(x)})"


def kl_sql(p: str, q: str) -> str:
    return f"list_sum(list_transform(list_zip({p}, {q}), lambda t: exp(t[1]) * (t[1] - t[2])))"


def logits(spark, sf):
    e = embeddings(spark, sf).select("id", F.transform(F.col("vec").cast("array<double>"), lambda x: x * 10).alias("v"), "label")
    teacher = e.select((F.col("id") - 1).alias("id"), F.col("v").alias("teacher"))
    mask = F.when(F.col("id") % 5 == 0, 0).otherwise(1)
    return e.join(teacher, "id").select("id", F.col("v").alias("student"), "teacher", "label", mask.alias("mask"))


@query("label_logprobs", f"with {LOGITS} select id, round(student[label + 1] - {lse_sql('student')}, 6) as logp from l")
def label_logprobs(spark, sf):
    return ls.label_logprobs(logits(spark, sf)).select("id", rounded(F.col("logp")).alias("logp"))


WEIGHT = f"least(greatest(exp((teacher[label + 1] - {lse_sql('teacher')}) - (student[label + 1] - {lse_sql('student')})), 0.5), 2.0)"
FULL_TERMS = f"""soft as (select *, {soft_sql('student')} as s, {soft_sql('teacher')} as t, {WEIGHT} as weight from l),
terms as (select id, mask, weight, {kl_sql('t', 's')} as forward_kl, {kl_sql('s', 't')} as reverse_kl from soft)"""


@query("divergences", f"""with {LOGITS}, {FULL_TERMS} select id, round(forward_kl, 6) as forward_kl, round(reverse_kl, 6) as reverse_kl,
 round(weight, 6) as weight, round((0.5 * forward_kl + 0.5 * reverse_kl) * weight, 6) as kl from terms""")
def divergences(spark, sf):
    terms = ls.distillation_terms(logits(spark, sf))
    return terms.select("id", *[rounded(F.col(c)).alias(c) for c in ("forward_kl", "reverse_kl", "weight", "kl")])


TOP_K = f"""places as (select *, list_transform(list_slice(list_sort(list_transform(teacher, lambda x, i: {{'neg': -x, 'i': i}})), 1, 8), lambda r: r.i) as top, {WEIGHT} as weight from l),
kept as (select id, mask, weight, list_concat(list_transform(top, lambda i: student[i]), [{lse_sql("list_filter(student, lambda x, i: not list_contains(top, i))")}]) as ks,
 list_concat(list_transform(top, lambda i: teacher[i]), [{lse_sql("list_filter(teacher, lambda x, i: not list_contains(top, i))")}]) as kt from places),
soft as (select *, {soft_sql('ks')} as s, {soft_sql('kt')} as t from kept),
terms as (select id, mask, weight, {kl_sql('t', 's')} as forward_kl, {kl_sql('s', 't')} as reverse_kl from soft)"""


@query("top_k_divergences", f"""with {LOGITS}, {TOP_K} select id, round(forward_kl, 6) as forward_kl, round(reverse_kl, 6) as reverse_kl,
 round((0.7 * forward_kl + 0.3 * reverse_kl) * weight, 6) as kl from terms""")
def top_k_divergences(spark, sf):
    terms = ls.distillation_terms(logits(spark, sf), Distillation(alpha=0.3, top_k=8))
    return terms.select("id", *[rounded(F.col(c)).alias(c) for c in ("forward_kl", "reverse_kl", "kl")])


@query("distillation_loss", f"""with {LOGITS}, {FULL_TERMS} select round(avg(forward_kl), 6) as forward_kl, round(avg(reverse_kl), 6) as reverse_kl,
 round(sum((0.5 * forward_kl + 0.5 * reverse_kl) * weight * mask) / sum(mask), 6) as distillation_loss from terms""")
def distillation_loss(spark, sf):
    return rounded_all(ls.distillation_loss(logits(spark, sf)))


@query("total_loss", f"""with {LOGITS}, {FULL_TERMS}, {advantages_cte('clamp')},
m as (select (select avg({TERM}) from a) as pg, avg((0.5 * forward_kl + 0.5 * reverse_kl) * weight) as d, avg(0.5 * forward_kl + 0.5 * reverse_kl) as k from terms)
select round(pg + d + 0.01 * k, 6) as total_loss from m""")
def total_loss(spark, sf):
    policy = ls.sequence_policy_loss(ls.group_advantages(samples(spark, sf), floor="clamp"))
    rows = logits(spark, sf)
    distilled = ls.distillation_loss(rows, mask=None).select("distillation_loss")
    reference = ls.distillation_loss(rows, Distillation(weight_clip=None), mask=None).select(F.col("distillation_loss").alias("reference_kl"))
    one = policy.select("policy_loss", distilled.scalar().alias("d"), reference.scalar().alias("k"))
    return one.select(rounded(ls.total_loss(F.col("policy_loss"), F.col("d"), F.col("k"), LossWeights())).alias("total_loss"))
