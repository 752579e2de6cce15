"""Rollouts made from conversations: rewards, demonstrations, prompts, metrics."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import functions as F

from corpuskit.config import (
    FEEDBACK_TEMPLATE, REPROMPT_TEMPLATE, SOLUTION_TEMPLATE, Reprompting,
)
from corpuskit.functions import rewards as rw
from corpuskit.functions import text as tx
from corpuskit.operators import rollouts as ro
from corpuskit.plans.catalog import query, rounded, stripped, table

# Conversations hold no code, boxes or markers, so each assistant turn is dressed
# up by the same rule in Spark and in SQL.  The text is valid in both.
RESPONSE = """case (conv_id + turn) % 7
 when 0 then 'First we add: 2 + 3 = 5. The Answer is: ' || cast(conv_id as varchar(20)) || '. ' || text
 when 1 then '<think>' || text || '</think> Step one. ' || chr(92) || 'boxed{ ' || cast(conv_id as varchar(20)) || ' }'
 when 2 then '```' || chr(10) || 'def f(x):' || chr(10) || '    return x' || chr(10) || '```' || text
 when 3 then text
 when 4 then 'class A:' || chr(10) || chr(9) || 'def g(self): final answer' || chr(10) || ' = ' || cast(length(text) as varchar(20)) || chr(10) || text
 when 5 then 'The answer is ' || chr(10) || 'therefore the result is  = ' || cast(length(text) as varchar(20))
 else 'First it equals 7*1' || chr(92) || 'boxed{}' end"""
ROLLOUTS = f"""select cast(floor(a.conv_id / 16) as bigint) as batch_id, a.conv_id as prompt_id,
  cast(a.turn as integer) as sample_id, p.prompt, a.response, p.prompt || chr(10) || a.response as full_sequence
from (select conv_id, turn, {RESPONSE} as response from conversations where role = 'assistant') a
join (select conv_id, min_by(text, turn) as prompt from conversations where role = 'user' group by conv_id) p
on p.conv_id = a.conv_id"""


def rollouts(spark, sf):
    source = ROLLOUTS.replace("from conversations", "from {conversations}").replace("boxed{", "boxed{{").replace("}", "}}").replace("{conversations}}", "{conversations}")
    return spark.sql(source, conversations=table(spark, sf, "conversations"))


ANSWER = f"case when regexp_matches(response, '{rw.BOXED_PATTERN}') then {stripped(f"regexp_extract(response, '{rw.BOXED_PATTERN}', 1)")}"
for _marker in rw.ANSWER_MARKERS:
    _pattern = rw.answer_pattern(_marker)
    ANSWER += f" when regexp_matches(response, '{_pattern}') then {stripped(f"regexp_extract(response, '{_pattern}', 1)")}"
ANSWER += " end"

MATH = f"""r as ({ROLLOUTS}), a as (select *, {ANSWER} as answer,
  regexp_matches(lower(response), '{rw.STEP_PATTERN}') as steps, regexp_matches(response, '{rw.OPERATOR_PATTERN}') as ops from r),
scored as (select batch_id, prompt_id, sample_id, prompt, response,
  case when coalesce(answer, '') <> '' then cast(0.5 as double) + (case when steps then cast(0.3 as double) else 0 end) + (case when ops then cast(0.2 as double) else 0 end) else 0 end as reward,
  case when coalesce(answer, '') <> '' then 'Answer extracted: ' || answer || (case when steps then '; Shows reasoning steps' else '' end) || (case when ops then '; Contains calculations' else '' end)
       else '{rw.NO_ANSWER}' end as feedback from a)"""
SCORED = "select batch_id, prompt_id, sample_id, round(reward, 6) as reward, feedback, reward >= 1.0 as is_success from scored"


def shown(scored):
    return scored.select(
        "batch_id", "prompt_id", "sample_id", rounded(F.col("reward")).alias("reward"), "feedback", "is_success"
    )


@query("rollouts", f"select batch_id, prompt_id, sample_id, md5(prompt) as prompt, md5(response) as response, md5(full_sequence) as full_sequence from ({ROLLOUTS})")
def rollouts_query(spark, sf):
    rows = rollouts(spark, sf)
    return rows.select("batch_id", "prompt_id", "sample_id", *[F.md5(c).alias(c) for c in ("prompt", "response", "full_sequence")])


@query("pattern_rewards", f"""with r as ({ROLLOUTS}), scored as (select *, case when regexp_matches(response, '[0-9]+ ?[.]') then cast(1 as double) else 0 end as reward,
 case when regexp_matches(response, '[0-9]+ ?[.]') then '{rw.ANSWER_FOUND}' else '{rw.ANSWER_MISSING}' end as feedback from r) {SCORED}""")
def pattern_rewards(spark, sf):
    return shown(ro.score(rollouts(spark, sf), lambda r: rw.pattern_reward(r, "[0-9]+ ?[.]")))


@query("length_rewards", f"""with r as ({ROLLOUTS}), scored as (select *, least(length(response) / 100.0, 1.0) as reward,
 'Response length: ' || length(response) || ' chars' as feedback from r) {SCORED}""")
def length_rewards(spark, sf):
    return shown(ro.score(rollouts(spark, sf), rw.pattern_reward))


CODE_CHECKS = (
    f"(contains(response, '{rw.FENCE}') or starts_with({stripped('response')}, 'def ') or starts_with({stripped('response')}, 'class '))",
    "contains(response, 'def ')",
    "contains(response, 'return ')",
    f"regexp_matches(response, '{rw.INDENT_PATTERN}')",
)


@query("code_rewards", f"""with r as ({ROLLOUTS}), scored as (select *,
 {' + '.join(f'(case when {c} then cast({w} as double) else 0 end)' for c, (w, _, _) in zip(CODE_CHECKS, rw.CODE_RULES))} as reward,
 {" || '; ' || ".join(f"(case when {c} then '{y}' else '{n}' end)" for c, (_, y, n) in zip(CODE_CHECKS, rw.CODE_RULES))} as feedback from r) {SCORED}""")
def code_rewards(spark, sf):
    return shown(ro.score(rollouts(spark, sf), rw.code_reward))


@query("extracted_answers", f"with r as ({ROLLOUTS}) select prompt_id, sample_id, {ANSWER} as answer from r")
def extracted_answers(spark, sf):
    return rollouts(spark, sf).select("prompt_id", "sample_id", rw.extract_answer(F.col("response")).alias("answer"))


def math_scored(spark, sf):
    return ro.score(rollouts(spark, sf), rw.math_reward)


@query("math_rewards", f"with {MATH} {SCORED}")
def math_rewards(spark, sf):
    return shown(math_scored(spark, sf))


@query("custom_rewards", f"""with r as ({ROLLOUTS}), scored as (select *, length(replace(response, ' ', '')) / cast(length(response) as double) as reward,
 cast(null as varchar) as feedback from r) {SCORED}""")
def custom_rewards(spark, sf):
    """A reward of one's own, as a pandas UDF."""

    @F.pandas_udf("double")
    def dense(response: pd.Series) -> pd.Series:
        return response.str.replace(" ", "", regex=False).str.len() / response.str.len()

    return shown(ro.score(rollouts(spark, sf), dense))


@query("default_rewards", f"with r as ({ROLLOUTS}), scored as (select *, cast(1 as double) as reward, cast(null as varchar) as feedback from r) {SCORED}")
def default_rewards(spark, sf):
    return shown(ro.score(rollouts(spark, sf), rw.constant_reward))


@query("successes_and_failures", f"""with {MATH} select batch_id, count(*) filter (where reward >= 1.0) as n_success,
 count(*) filter (where reward < 1.0) as n_failed from scored group by batch_id""")
def successes_and_failures(spark, sf):
    scored = math_scored(spark, sf)
    won = ro.successes(scored).groupBy("batch_id").agg(F.count("*").alias("n_success"))
    lost = ro.failures(scored).groupBy("batch_id").agg(F.count("*").alias("n_failed"))
    return won.join(lost, "batch_id", "full").na.fill(0)


def quoted(template: str) -> str:
    return "'" + template.replace("\n", "' || chr(10) || '") + "'"


def filled(template: str, **values: str) -> str:
    sql = quoted(template)
    for name, value in values.items():
        sql = sql.replace("{" + name + "}", f"' || {value} || '")
    return sql


THOUGHTLESS = "chosen"
for _p in tx.THINKING_PATTERNS:
    THOUGHTLESS = f"regexp_replace({THOUGHTLESS}, '{_p}', '', 'g')"
THOUGHTLESS = stripped(THOUGHTLESS)


def reprompt_sql(scored: str, threshold: float, feedback: str, cut: str) -> str:
    return f"""with {scored},
won as (select batch_id, response, min({{'neg': -reward, 'p': prompt_id, 's': sample_id}}) as spot from scored where reward >= {threshold} group by 1, 2),
ranked as (select *, row_number() over (partition by batch_id order by spot) as place from won),
demo as (select batch_id, max(case when place = 1 then response end) as best, max(case when place = 2 then response end) as other from ranked group by 1),
failed as (select batch_id, arg_min(feedback, {{'p': prompt_id, 's': sample_id}}) as failed_feedback from scored where reward < {threshold} group by 1),
joined as (select s.*, best, failed_feedback, case when s.response = best and other is not null then other else best end as chosen
  from scored s left join demo using (batch_id) left join failed using (batch_id)),
picked as (select *, {THOUGHTLESS} as demonstration, {feedback} as chosen_feedback from joined),
made as (select *, {filled(REPROMPT_TEMPLATE, prompt='prompt',
    solution="(case when coalesce(demonstration, '') = '' then '' else " + filled(SOLUTION_TEMPLATE, successful_previous_attempt='demonstration') + " end)",
    feedback="(case when coalesce(chosen_feedback, '') = '' then '' else " + filled(FEEDBACK_TEMPLATE, feedback_raw='chosen_feedback') + " end)")} as full_prompt from picked)
select batch_id, prompt_id, sample_id, md5(demonstration) as demonstration, chosen_feedback, md5({cut}) as reprompted_prompt from made"""


def reprompted(spark, sf, config):
    out = ro.reprompt(math_scored(spark, sf), config)
    return out.select(
        "batch_id", "prompt_id", "sample_id", F.md5("demonstration").alias("demonstration"),
        "chosen_feedback", F.md5("reprompted_prompt").alias("reprompted_prompt"),
    )


@query("reprompted", reprompt_sql(MATH, 1.0, "case when best is not null then null when reward < 1.0 then feedback else failed_feedback end", "left(full_prompt, 10240)"))
def reprompted_query(spark, sf):
    return reprompted(spark, sf, Reprompting())


@query("reprompted_with_feedback", reprompt_sql(MATH, 0.7, "case when reward < 0.7 then feedback else failed_feedback end", "right(full_prompt, 300)"))
def reprompted_with_feedback(spark, sf):
    return reprompted(spark, sf, Reprompting(
        success_threshold=0.7, feedback_only_without_solution=False, max_chars=300, truncation="left"
    ))


@query("batch_metrics", f"""with {MATH} select batch_id, round(avg(reward), 6) as mean_reward,
 round(avg(case when reward >= 1.0 then 1.0 else 0.0 end), 6) as success_rate from scored group by batch_id""")
def batch_metrics(spark, sf):
    rows = ro.batch_metrics(math_scored(spark, sf))
    return rows.withColumns({c: rounded(F.col(c)) for c in ("mean_reward", "success_rate")})


@query("epoch_metrics", f"""with {MATH}, b as (select batch_id, avg(reward) as mean_reward from scored group by batch_id)
select cast(batch_id % 3 as integer) as epoch, round(avg(mean_reward), 6) as mean_reward from b group by 1""")
def epoch_metrics(spark, sf):
    """Batches dealt to three epochs."""
    steps = ro.batch_metrics(math_scored(spark, sf)).withColumn("epoch", (F.col("batch_id") % 3).cast("int"))
    return ro.epoch_metrics(steps).withColumn("mean_reward", rounded(F.col("mean_reward")))
