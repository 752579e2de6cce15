"""Group advantages and losses, evaluated over tables of log probabilities and logits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpuskit.config import Distillation, LossWeights
from corpuskit.functions import logits as lg
from corpuskit.functions import vectors
from corpuskit.operators.lookup import lookup_join
from corpuskit.operators.numbering import dense_ids

STD_FLOOR = 1e-8


def group_advantages(
    rewards: DataFrame, by: str = "prompt_id", reward: str = "reward", floor: str = "add"
) -> DataFrame:
    """Add ``advantage``: the reward in units of its group's sample deviation.

    ``floor`` guards against a deviation of zero: ``add`` adds 1e-8, ``clamp``
    raises it to 1e-8.  A group of one gets 0.  The group figures are partial
    aggregates joined back, so a huge group is not gathered in one task.
    """
    stats = rewards.groupBy(by).agg(
        F.avg(reward).alias("_mean"), F.stddev_samp(reward).alias("_std")
    )
    std = F.col("_std")
    guarded = std + STD_FLOOR if floor == "add" else F.greatest(std, F.lit(STD_FLOOR))
    advantage = F.coalesce((F.col(reward) - F.col("_mean")) / guarded, F.lit(0.0))
    return lookup_join(rewards, stats, by).withColumn("advantage", advantage).drop("_mean", "_std")


def consecutive_advantages(rewards: DataFrame, group_size: int, seq: str = "seq") -> DataFrame:
    """The same for every ``group_size`` consecutive rows in the order of ``seq``.

    Rows are numbered without gaps, whatever the values of ``seq``; rows of the
    unfinished group at the end get 0.
    """
    numbered = dense_ids(rewards.withColumn("_seq", F.col(seq)), "_seq", id_type="bigint")
    grouped = numbered.withColumn("_group", F.floor(F.col("id") / group_size).cast("bigint")).drop("id", "_seq")
    sizes = grouped.groupBy("_group").agg(F.count(F.lit(1)).alias("_size"))
    out = lookup_join(group_advantages(grouped, "_group"), sizes, "_group")
    full = F.col("_size") == group_size
    return out.withColumn("advantage", F.when(full, F.col("advantage")).otherwise(0.0)).drop(
        "_group", "_size"
    )


def masked_mean(value: Column, mask: Column | None = None) -> Column:
    """Aggregate: mean over the rows whose mask is 1, or over all rows."""
    return F.avg(value) if mask is None else F.try_divide(F.sum(value * mask), F.sum(mask))


def policy_term(logp: Column, old_logp: Column, advantage: Column, clip: float | None = 0.2) -> Column:
    """Minus the (clipped) ratio times the advantage."""
    ratio = F.exp(logp - old_logp)
    if clip is None:
        return -(ratio * advantage)
    clipped = F.least(F.greatest(ratio, F.lit(1.0 - clip)), F.lit(1.0 + clip))
    return -F.least(ratio * advantage, clipped * advantage)


def token_policy_loss(tokens: DataFrame, clip: float | None = 0.2, mask: str | None = "mask") -> DataFrame:
    """One row ``(pg_loss, mean_ratio, mean_advantage)`` over token rows.

    The mean advantage is over sequences ``(prompt_id, sample_id)``, as each
    has one advantage however long it is.
    """
    term = policy_term(F.col("logp"), F.col("old_logp"), F.col("advantage"), clip)
    weight = None if mask is None else F.col(mask)
    loss = term if weight is None else term * weight
    per_sequence = tokens.groupBy("prompt_id", "sample_id").agg(
        F.sum(loss).alias("loss"),
        (F.count(F.lit(1)) if weight is None else F.sum(weight)).alias("n"),
        F.sum(F.exp(F.col("logp") - F.col("old_logp"))).alias("ratio"),
        F.count(F.lit(1)).alias("n_tokens"),
        F.max("advantage").alias("advantage"),
    )
    return per_sequence.agg(
        F.try_divide(F.sum("loss"), F.sum("n")).alias("pg_loss"),
        (F.sum("ratio") / F.sum("n_tokens")).alias("mean_ratio"),
        F.avg("advantage").alias("mean_advantage"),
    )


def sequence_policy_loss(samples: DataFrame, clip: float = 0.2) -> DataFrame:
    """One row ``policy_loss`` over sequence rows ``(logp, old_logp, advantage)``."""
    term = policy_term(F.col("logp"), F.col("old_logp"), F.col("advantage"), clip)
    return samples.agg(F.avg(term).alias("policy_loss"))


def kl_penalty(weight: float, logp: Column, ref_logp: Column | None = None) -> Column:
    """Aggregate: weighted mean distance to the reference; 0 without one or without weight."""
    if ref_logp is None or weight <= 0:
        return F.lit(0.0)
    return F.lit(weight) * F.avg(logp - ref_logp)


def step_metrics(
    samples: DataFrame, clip: float = 0.2, kl_weight: float = 0.0, by: str = "prompt_id"
) -> DataFrame:
    """One row of group-relative step metrics over ``(reward, logp, old_logp[, ref_logp])``."""
    rows = group_advantages(samples, by, floor="clamp")
    ref = F.col("ref_logp") if "ref_logp" in samples.columns else None
    term = policy_term(F.col("logp"), F.col("old_logp"), F.col("advantage"), clip)
    metrics = rows.agg(
        F.avg(term).alias("policy_loss"),
        kl_penalty(kl_weight, F.col("logp"), ref).alias("kl_loss"),
        F.avg("reward").alias("mean_reward"),
        F.avg("advantage").alias("mean_advantage"),
    )
    return metrics.withColumn("total_loss", F.col("policy_loss") + F.col("kl_loss"))


def label_logprobs(rows: DataFrame, logits: str = "student", label: str = "label") -> DataFrame:
    return rows.withColumn("logp", lg.label_logprob(F.col(logits), F.col(label)))


def distillation_terms(rows: DataFrame, config: Distillation = Distillation()) -> DataFrame:
    """Add ``forward_kl``, ``reverse_kl``, ``weight`` and ``kl`` to ``(student, teacher[, label])``.

    The importance weight is taken over the full distributions, before the
    logits are cut to the teacher's top k.
    """
    student, teacher = F.col("student"), F.col("teacher")
    weight = F.lit(1.0)
    if config.weight_clip is not None and "label" in rows.columns:
        weight = lg.importance_weight(student, teacher, F.col("label"), config.weight_clip)
    rows = rows.withColumn("weight", weight)
    if config.top_k is not None:
        rows = rows.withColumn("_at", lg.top_k_positions(teacher, config.top_k))
        student, teacher = (
            lg.keep_positions(x, F.col("_at"), config.add_tail) for x in (student, teacher)
        )
    rows = rows.withColumns({"_s": lg.log_softmax(student), "_t": lg.log_softmax(teacher)})
    rows = rows.withColumns(
        {
            "forward_kl": lg.divergence(F.col("_t"), F.col("_s")),
            "reverse_kl": lg.divergence(F.col("_s"), F.col("_t")),
        }
    )
    forward, reverse, a = F.col("forward_kl"), F.col("reverse_kl"), config.alpha
    mixed = forward if a == 0 else reverse if a == 1 else (1 - a) * forward + a * reverse
    return rows.withColumn("kl", mixed * F.col("weight")).drop("_s", "_t", "_at")


def distillation_loss(rows: DataFrame, config: Distillation = Distillation(), mask: str | None = "mask") -> DataFrame:
    """One row ``(forward_kl, reverse_kl, distillation_loss)``."""
    terms = distillation_terms(rows, config)
    return terms.agg(
        F.avg("forward_kl").alias("forward_kl"),
        F.avg("reverse_kl").alias("reverse_kl"),
        masked_mean(F.col("kl"), None if mask is None else F.col(mask)).alias("distillation_loss"),
    )


def total_loss(
    policy: Column, distillation: Column, reference_kl: Column, weights: LossWeights = LossWeights()
) -> Column:
    return (
        policy * weights.policy
        + distillation * weights.distillation
        + reference_kl * weights.reference_kl
    )


def moving_average(teacher: DataFrame, student: DataFrame, rate: float = 0.05, key: str = "id") -> DataFrame:
    """Teacher vectors moved towards the student's, matched by key."""
    s = student.select(key, F.col("vec").alias("_new"))
    mixed = vectors.mix(
        vectors.as_double(F.col("vec")), vectors.as_double(F.col("_new")), rate
    )
    return teacher.join(s, key).withColumn("vec", mixed).drop("_new")
