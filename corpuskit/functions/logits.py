"""Column expressions over logit arrays of one position."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from corpuskit.functions.arrays import let


def logsumexp(logits: Column) -> Column:
    """Log of the sum of exponentials, shifted by the maximum; null for an empty array."""

    def shifted(top: Column) -> Column:
        return top + F.log(F.aggregate(logits, F.lit(0.0), lambda acc, x: acc + F.exp(x - top)))

    return let(F.array_max(logits), shifted)


def log_softmax(logits: Column) -> Column:
    return let(logsumexp(logits), lambda total: F.transform(logits, lambda x: x - total))


def label_logprob(logits: Column, label: Column) -> Column:
    """Log probability of the (zero-based) label."""
    return F.element_at(logits, label + 1) - logsumexp(logits)


def divergence(p_log: Column, q_log: Column) -> Column:
    """KL(p || q) from log probabilities; a term with p = 0 adds nothing."""
    terms = F.zip_with(
        p_log, q_log, lambda p, q: F.when(F.exp(p) == 0, 0.0).otherwise(F.exp(p) * (p - q))
    )
    return F.aggregate(terms, F.lit(0.0), lambda acc, x: acc + x)


def top_k_positions(logits: Column, k: int) -> Column:
    """Zero-based positions of the ``k`` largest entries, best first, lower position on a tie."""
    ranked = F.array_sort(
        F.transform(logits, lambda x, i: F.struct((-x).alias("neg"), i.alias("at")))
    )
    return F.transform(F.slice(ranked, 1, k), lambda r: r["at"])


def keep_positions(logits: Column, positions: Column, add_tail: bool) -> Column:
    """Logits at the given positions, then (optionally) one bucket holding all the rest."""
    kept = F.transform(positions, lambda at: F.element_at(logits, at + 1))
    if not add_tail:
        return kept
    rest = F.filter(logits, lambda x, i: ~F.array_contains(positions, i))
    tail = F.when(F.size(rest) > 0, logsumexp(rest)).otherwise(F.lit(float("-inf")))
    return F.concat(kept, F.array(tail))


def importance_weight(
    student: Column, teacher: Column, label: Column, clip: float
) -> Column:
    """exp(teacher - student) at the label, held inside [1/clip, clip]."""
    ratio = F.exp(label_logprob(teacher, label) - label_logprob(student, label))
    return F.least(F.greatest(ratio, F.lit(1.0 / clip)), F.lit(float(clip)))
