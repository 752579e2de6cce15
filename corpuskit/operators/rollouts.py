"""Scoring rollouts, choosing demonstrations and feedback, building new prompts.

Input: ``(batch_id, prompt_id, sample_id, prompt, response, full_sequence)``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpuskit.config import Reprompting
from corpuskit.functions import text as tx
from corpuskit.operators.lookup import lookup_join

# Fixed value: the feedback of a failed answer that has none.
MISSING_FEEDBACK = "Previous attempt was incorrect."


def score(
    rollouts: DataFrame, reward: Callable[[Column], Column], threshold: float = 1.0
) -> DataFrame:
    """Add ``reward``, ``feedback`` and ``is_success``.

    ``reward`` maps the response column to a struct of reward and feedback, or
    to a plain number (a pandas UDF, say).
    """
    scored = rollouts.withColumn("_score", reward(F.col("response")))
    if dict(scored.dtypes)["_score"].startswith("struct"):
        scored = scored.withColumns(
            {"reward": F.col("_score.reward"), "feedback": F.col("_score.feedback")}
        )
    else:
        scored = scored.withColumns(
            {"reward": F.col("_score").cast("double"), "feedback": F.lit(None).cast("string")}
        )
    return scored.drop("_score").withColumn("is_success", F.col("reward") >= threshold)


def successes(rollouts: DataFrame, threshold: float = 1.0) -> DataFrame:
    return rollouts.where(F.col("reward") >= threshold)


def failures(rollouts: DataFrame, threshold: float = 1.0) -> DataFrame:
    return rollouts.where(F.col("reward") < threshold)


def demonstrations(rollouts: DataFrame, threshold: float, scope: str = "batch_id") -> DataFrame:
    """Per batch the best successful response and the best one with another text.

    Equal texts fold together first, then a top two per batch: Spark cuts each
    partition to two rows per batch before the shuffle, so a huge batch is cheap.
    """
    folded = successes(rollouts, threshold).groupBy(scope, "response").agg(
        F.min(F.struct((-F.col("reward")).alias("neg"), "prompt_id", "sample_id")).alias("at")
    )
    place = F.row_number().over(Window.partitionBy(scope).orderBy("at"))
    top = folded.withColumn("place", place).where(F.col("place") <= 2)
    return top.groupBy(scope).agg(
        F.max(F.when(F.col("place") == 1, F.col("response"))).alias("best"),
        F.max(F.when(F.col("place") == 2, F.col("response"))).alias("other"),
    )


def first_failures(rollouts: DataFrame, threshold: float, scope: str = "batch_id") -> DataFrame:
    """Per batch the feedback of its first failed row."""
    failed = failures(rollouts, threshold)
    place = F.row_number().over(Window.partitionBy(scope).orderBy("prompt_id", "sample_id"))
    return failed.select(scope, "prompt_id", "sample_id", "feedback").withColumn(
        "place", place
    ).where(F.col("place") == 1).select(
        scope, F.col("feedback").alias("failed_feedback"), F.lit(True).alias("has_failure")
    )


def build_prompt(prompt: Column, demonstration: Column, feedback: Column, config: Reprompting) -> Column:
    """Fill the templates; sections without content vanish; then truncate."""

    def section(template: str, name: str, value: Column) -> Column:
        return F.when(F.coalesce(value, F.lit("")) == "", "").otherwise(
            tx.fill_template(template, **{name: value})
        )

    filled = tx.fill_template(
        config.reprompt_template,
        prompt=prompt,
        solution=section(config.solution_template, "successful_previous_attempt", demonstration),
        feedback=section(config.feedback_template, "feedback_raw", feedback),
    )
    return tx.truncate_chars(filled, config.max_chars, config.truncation)


def reprompt(
    rollouts: DataFrame, config: Reprompting = Reprompting(), scope: str = "batch_id"
) -> DataFrame:
    """Add ``demonstration``, ``chosen_feedback`` and ``reprompted_prompt`` to scored rollouts."""
    threshold = config.success_threshold
    has_feedback = "feedback" in rollouts.columns
    if not has_feedback:
        rollouts = rollouts.withColumn("feedback", F.lit(MISSING_FEEDBACK))
    per_batch = demonstrations(rollouts, threshold, scope).join(
        first_failures(rollouts, threshold, scope), scope, "full"
    )
    joined = lookup_join(rollouts, per_batch, scope)
    best, other = F.col("best"), F.col("other")
    chosen = best
    if config.skip_own_success:
        chosen = F.when((F.col("response") == best) & other.isNotNull(), other).otherwise(best)
    demonstration = tx.remove_thinking(chosen) if config.remove_thinking else chosen
    nothing = F.lit(None).cast("string")
    own = (F.col("reward") < threshold) & F.lit(has_feedback)
    feedback = F.when(own, F.col("feedback")).when(
        F.coalesce("has_failure", F.lit(False)), F.col("failed_feedback")
    )
    if not config.include_feedback:
        feedback = nothing
    elif config.feedback_only_without_solution:
        feedback = F.when(best.isNotNull(), nothing).otherwise(feedback)
    out = joined.withColumns({"demonstration": demonstration, "chosen_feedback": feedback})
    prompt = build_prompt(
        F.col("prompt"), F.col("demonstration"), F.col("chosen_feedback"), config
    )
    dropped = ["best", "other", "failed_feedback", "has_failure"]
    return out.withColumn("reprompted_prompt", prompt).drop(
        *dropped, *([] if has_feedback else ["feedback"])
    )


def batch_metrics(rollouts: DataFrame, threshold: float = 1.0, by: str = "batch_id") -> DataFrame:
    """Mean reward and success rate per batch."""
    won = F.when(F.col("reward") >= threshold, 1.0).otherwise(0.0)
    return rollouts.groupBy(by).agg(
        F.avg("reward").alias("mean_reward"), F.avg(won).alias("success_rate")
    )


def epoch_metrics(
    steps: DataFrame, by: str = "epoch",
    names: tuple[str, ...] = ("total_loss", "pg_loss", "distillation_loss", "kl_penalty", "mean_reward"),
) -> DataFrame:
    """Mean of the step metrics per epoch; only the named ones that are present."""
    present = [n for n in names if n in steps.columns]
    return steps.groupBy(by).agg(*[F.avg(n).alias(n) for n in present])
