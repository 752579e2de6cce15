import math

import pytest
from pyspark.sql import functions as F

from corpuskit.config import Distillation, Reprompting
from corpuskit.functions import rewards as rw
from corpuskit.operators import losses as ls
from corpuskit.operators import rollouts as ro


def scored_by(spark, reward, *responses):
    rows = spark.createDataFrame([(i, r) for i, r in enumerate(responses)], "i int, response string")
    return [(r["reward"], r["feedback"]) for r in ro.score(rows, reward).orderBy("i").collect()]


def test_math_reward(spark):
    got = scored_by(
        spark, rw.math_reward, "Step 1: 2+3=5. The answer is 5", "\\boxed{ }", "\\boxed{7}",
        "answer is \n", "no idea", "It EQUALS 4\nso", "final answer: x",
    )
    assert got[0] == (1.0, "Answer extracted: 5; Shows reasoning steps; Contains calculations")
    assert [g[0] for g in got[1:]] == [0.0, 0.5, 0.0, 0.0, 0.5, 0.5]
    assert got[5][1] == "Answer extracted: 4"


def test_code_reward(spark):
    got = scored_by(spark, rw.code_reward, "```\ndef f():\n    return x\n```", "plain text")
    assert got[0][0] == 1.0
    assert got[1] == (0.0, "No code block found; Missing function definition; Missing return statement; Check indentation")


def test_length_reward(spark):
    got = scored_by(spark, rw.pattern_reward, "é" * 50, "x" * 300)
    assert got == [(0.5, "Response length: 50 chars"), (1.0, "Response length: 300 chars")]


ROLLOUT = "batch_id int, prompt_id int, sample_id int, prompt string, response string, reward double, feedback string"


def test_demonstrations(spark):
    rows = spark.createDataFrame(
        [(0, 1, 0, "p", "x", 1.0, "fx"), (0, 1, 1, "p", "y", 1.0, "fy"), (0, 2, 0, "q", "z", 0.0, "fz"),
         (1, 3, 0, "r", "only", 1.0, "f"), (2, 4, 0, "s", "bad", 0.0, None), (2, 4, 1, "s", "worse", 0.5, "hint")],
        ROLLOUT,
    )
    out = {r["response"]: r for r in ro.reprompt(rows).collect()}
    assert (out["x"]["demonstration"], out["y"]["demonstration"], out["z"]["demonstration"]) == ("y", "x", "x")
    assert out["only"]["demonstration"] == "only"
    assert all(out[r]["chosen_feedback"] is None for r in ("x", "y", "z", "only", "bad"))
    assert out["worse"]["chosen_feedback"] == "hint"
    assert out["z"]["reprompted_prompt"] == (
        "q\n\nHere is a previous attempt and feedback:\n<|solution|>\nx\n<|/solution|>\nNow, try again with this knowledge.\n"
    )
    assert "solution" not in out["worse"]["reprompted_prompt"]
    with_feedback = Reprompting(feedback_only_without_solution=False)
    out = {r["response"]: r for r in ro.reprompt(rows, with_feedback).collect()}
    assert (out["x"]["chosen_feedback"], out["z"]["chosen_feedback"], out["only"]["chosen_feedback"]) == ("fz", "fz", None)
    out = ro.reprompt(rows.drop("feedback"), with_feedback).where("response = 'z'").first()
    assert out["chosen_feedback"] == ro.MISSING_FEEDBACK


def test_template_text_is_not_filled_twice(spark):
    rows = spark.createDataFrame([(0, 1, 0, "{solution}{prompt}", "a {feedback}", 1.0, "f")], ROLLOUT)
    prompt = ro.reprompt(rows).first()["reprompted_prompt"]
    assert prompt.startswith("{solution}{prompt}\n\n") and "a {feedback}" in prompt


def test_too_long_prompt_raises(spark):
    rows = spark.createDataFrame([(0, 1, 0, "p" * 99, "x", 1.0, "f")], ROLLOUT)
    with pytest.raises(Exception, match="exceeds max length"):
        ro.reprompt(rows, Reprompting(max_chars=50, truncation="error")).collect()


def test_advantages(spark):
    rows = spark.createDataFrame(
        [(0, i, r) for i, r in enumerate([1.0, 0.0, 0.0, 1.0])] + [(1, 4, 0.8), (1, 5, 0.8), (2, 6, 1.0)],
        "prompt_id int, seq int, reward double",
    )
    got = {r["seq"]: r["advantage"] for r in ls.group_advantages(rows).collect()}
    assert [round(got[i], 4) for i in range(4)] == [0.866, -0.866, -0.866, 0.866]
    assert abs(got[4]) < 1e-6 and got[6] == 0.0
    got = {r["seq"]: r["advantage"] for r in ls.consecutive_advantages(rows, 4).collect()}
    assert got[0] > 0.8 and got[5] == got[6] == 0.0


def test_clipped_loss(spark):
    rows = spark.createDataFrame([(math.log(1.5), 0.0, 1.0), (math.log(1.5), 0.0, -1.0)], "a double, b double, adv double")
    got = [r[0] for r in rows.select(ls.policy_term(F.col("a"), F.col("b"), F.col("adv"))).collect()]
    assert got == pytest.approx([-1.2, 1.5])


def test_divergence_properties(spark):
    rows = spark.createDataFrame(
        [([1.0, 2.0, 0.5], [1.0, 2.0, 0.5], 0, 1), ([3.0, 0.0, -2.0], [0.0, 1.0, 5.0], 2, 1)],
        "student array<double>, teacher array<double>, label int, mask int",
    )
    for config in (Distillation(), Distillation(top_k=2), Distillation(top_k=3), Distillation(top_k=2, add_tail=False)):
        same, other = ls.distillation_terms(rows, config).select("forward_kl", "reverse_kl", "weight").collect()
        assert same["forward_kl"] == pytest.approx(0) and same["reverse_kl"] == pytest.approx(0)
        assert other["forward_kl"] > 0 and other["reverse_kl"] > 0 and other["weight"] == 2.0
    full = ls.distillation_terms(rows).collect()[1]["forward_kl"]
    whole = ls.distillation_terms(rows, Distillation(top_k=3)).collect()[1]["forward_kl"]
    assert whole == pytest.approx(full)
