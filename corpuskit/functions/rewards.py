"""Rule-based rewards as columns of a response; stateless, so they work on streams."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from corpuskit.functions.text import WS, strip

# Weights, markers, patterns and messages of the rules.
ANSWER_FOUND = "Correct answer found!"
ANSWER_MISSING = "Answer pattern not found. Try again."
FENCE = "```"
INDENT_PATTERN = r"(^|\n)(    |\t)"
CODE_RULES = (
    (0.3, "Code block detected", "No code block found"),
    (0.3, "Function definition found", "Missing function definition"),
    (0.2, "Return statement found", "Missing return statement"),
    (0.2, "Proper indentation detected", "Check indentation"),
)
BOXED_PATTERN = r"\\boxed\{([^}]+)\}"
ANSWER_MARKERS = ("answer is", "final answer", "result is", "equals")
ANSWER_TAIL = rf"[{WS}]*[:=]?[{WS}]*([^\n\.]+)"
STEP_PATTERN = "step|first|then|therefore"
OPERATOR_PATTERN = r"[=+\-*/]"
LENGTH_MESSAGE = ("Response length: ", " chars")
ANSWER_MESSAGE = "Answer extracted: "
STEPS_MESSAGE = "; Shows reasoning steps"
OPERATORS_MESSAGE = "; Contains calculations"
NO_ANSWER = "Could not extract final answer. Use \\boxed{} or clearly state your answer."


def answer_pattern(marker: str) -> str:
    """The rest of the sentence after a marker, whatever its case."""
    return f"(?i){marker}{ANSWER_TAIL}"


def scored(reward: Column, feedback: Column) -> Column:
    return F.struct(reward.cast("double").alias("reward"), feedback.alias("feedback"))


def pattern_reward(response: Column, pattern: str | None = None) -> Column:
    """1 when the pattern is found, else 0; without a pattern the length, up to 1."""
    if pattern:
        found = F.rlike(response, F.lit(pattern))
        return scored(
            F.when(found, 1.0).otherwise(0.0),
            F.when(found, ANSWER_FOUND).otherwise(ANSWER_MISSING),
        )
    n = F.length(response)
    message = F.concat(F.lit(LENGTH_MESSAGE[0]), n.cast("string"), F.lit(LENGTH_MESSAGE[1]))
    return scored(F.least(n / F.lit(100.0), F.lit(1.0)), message)


def code_reward(response: Column) -> Column:
    """Code block, function, return and indentation, added in this order."""
    bare = strip(response)
    checks = (
        F.contains(response, F.lit(FENCE)) | bare.startswith("def ") | bare.startswith("class "),
        F.contains(response, F.lit("def ")),
        F.contains(response, F.lit("return ")),
        F.rlike(response, F.lit(INDENT_PATTERN)),
    )
    reward = F.lit(0.0)
    messages = []
    for passed, (weight, yes, no) in zip(checks, CODE_RULES):
        reward = reward + F.when(passed, weight).otherwise(0.0)
        messages.append(F.when(passed, yes).otherwise(no))
    return scored(reward, F.concat_ws("; ", *messages))


def extract_answer(response: Column) -> Column:
    """Boxed answer, else what follows the first marker that matches; may be empty or null."""
    answer = F.when(
        F.rlike(response, F.lit(BOXED_PATTERN)),
        strip(F.regexp_extract(response, BOXED_PATTERN, 1)),
    )
    for marker in ANSWER_MARKERS:
        pattern = answer_pattern(marker)
        answer = answer.when(
            F.rlike(response, F.lit(pattern)), strip(F.regexp_extract(response, pattern, 1))
        )
    return answer


def math_reward(response: Column) -> Column:
    """Half for an answer, more for reasoning words and for operators."""
    answer = extract_answer(response)
    has_answer = F.coalesce(answer != "", F.lit(False))
    steps = F.rlike(F.lower(response), F.lit(STEP_PATTERN))
    operators = F.rlike(response, F.lit(OPERATOR_PATTERN))
    reward = F.lit(0.5) + F.when(steps, 0.3).otherwise(0.0) + F.when(operators, 0.2).otherwise(0.0)
    message = F.concat(
        F.lit(ANSWER_MESSAGE), answer,
        F.when(steps, STEPS_MESSAGE).otherwise(""),
        F.when(operators, OPERATORS_MESSAGE).otherwise(""),
    )
    return scored(
        F.when(has_answer, reward).otherwise(0.0), F.when(has_answer, message).otherwise(NO_ANSWER)
    )


def constant_reward(response: Column) -> Column:
    """The default reward: everything scores 1, without feedback."""
    return scored(F.when(response.isNotNull(), 1.0).otherwise(1.0), F.lit(None).cast("string"))
