"""Quality rules as a short-circuit cascade: cheap and selective rules first, by estimates from a sample."""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpuskit.llm import text_figures as figures
from corpuskit.llm.common import with_columns
from corpuskit.llm.token_ids import array_groups

SAMPLE_ROWS = 500
SYMBOLS = "#*$%&|<>"
BLANK_CHARACTERS = figures.BLANKS

# What is measured once a text and shared by the rules that ask for it.
MEASURES: dict[str, Callable[[str], object]] = {
    "words": figures.word_count,
    "word_chars": lambda text: len(text) - figures.count_of(text, BLANK_CHARACTERS),
    "symbols": lambda text: figures.count_of(text, SYMBOLS),
    "lines": figures.line_counts,
    "repeated": figures.repeated_words,
}


class Measured(dict):
    """Measures of one text, each made when it is first asked for."""

    def __init__(self, text: str) -> None:
        self.text = text

    def __missing__(self, name: str) -> object:
        self[name] = value = MEASURES[name](self.text)
        return value


@dataclass(frozen=True)
class Rule:
    """Rejects a text by some of its measures."""

    name: str
    needs: tuple[str, ...]
    rejects: Callable[[Measured], bool]
    base: bool = False


RULES = (
    Rule("few_words", ("words",), lambda m: m["words"] < 50, base=True),
    Rule("repeated_windows", ("repeated", "words"), lambda m: 100 * m["repeated"] > 50 * m["words"], base=True),
    Rule("symbols", ("symbols", "words"), lambda m: 10 * m["symbols"] > m["words"]),
    Rule("word_length", ("word_chars", "words"), lambda m: not 3 * m["words"] <= m["word_chars"] <= 10 * m["words"]),
    Rule("repeated_lines", ("lines",), lambda m: 100 * m["lines"][1] > 50 * m["lines"][0]),
)


def trials(docs: DataFrame, rules: tuple[Rule, ...], rows: int, text: str) -> list[tuple[dict[str, int], list[bool]]]:
    """For about ``rows`` texts drawn at random: nanoseconds of each measure, and each rule's verdict.

    The texts stay in the tasks; a few numbers a text come back.
    """
    total = docs.count()
    if not total:
        return []
    drawn = docs.select(F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text")).sample(min(1.0, rows / total), seed=13)
    names = sorted({need for rule in rules for need in rule.needs})

    def tried(batches):
        for batch in batches:
            for part in array_groups(batch.column(0), 1_000_000):
                spent, verdicts = [], []
                for value in part.to_pylist():
                    measured = Measured(value)
                    clock = [time.perf_counter_ns()]
                    for name in names:
                        measured[name]
                        clock.append(time.perf_counter_ns())
                    spent.append([b - a for a, b in zip(clock, clock[1:])])
                    verdicts.append([rule.rejects(measured) for rule in rules])
                yield pa.RecordBatch.from_pydict({"spent": pa.array(spent, pa.list_(pa.int64())), "verdicts": pa.array(verdicts, pa.list_(pa.bool_()))})

    found = drawn.mapInArrow(tried, "spent array<bigint>, verdicts array<boolean>").collect()
    return [(dict(zip(names, r["spent"])), r["verdicts"]) for r in found]


def ordered(tried: list[tuple[dict[str, int], list[bool]]], rules: tuple[Rule, ...]) -> tuple[Rule, ...]:
    """Rules by rejection per cost, greedily.

    The next rule is the one that rejects most of the texts still in the race, per nanosecond that its
    measures not yet made would take on them.  Rules that reject none of them follow by cost.
    """
    left, made, out = list(range(len(rules))), set(), []
    alive = tried
    while left:

        def worth(n: int) -> tuple[float, float]:
            cost = 1 + sum(spent[need] for spent, _ in alive for need in rules[n].needs if need not in made)
            return sum(verdict[n] for _, verdict in alive) / cost, -cost

        best = max(left, key=worth)
        left.remove(best)
        made.update(rules[best].needs)
        alive = [t for t in alive if not t[1][best]]
        out.append(rules[best])
    return tuple(out)


def plan(docs: DataFrame, rules: tuple[Rule, ...] = RULES, rows: int = SAMPLE_ROWS, text: str = "text") -> tuple[Rule, ...]:
    """The rules in the order in which ``judged`` tries them, from a sample of about ``rows`` texts."""
    return ordered(trials(docs, rules, rows, text), rules)


def judged(docs: DataFrame, rules: tuple[Rule, ...], text: str = "text", report: bool = False) -> DataFrame:
    """All columns of ``docs``, then ``kept``, ``rejected_by`` and ``n_tried``; with ``report`` also the figures.

    Rules are tried in the given order until one rejects, so a text pays only for the measures asked for
    until then.  ``kept`` is true if none rejects and does not depend on the order; ``rejected_by`` is the
    first that does (null if kept).  ``report`` makes the other measures too, after the verdict:
    ``n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words`` (longs), and ``base_failed``, whether
    a base rule rejects.  Columns of these names are replaced.  A null text has no words.  The rules look
    at one text at a time, so ties, repeated rows and null ids need no rule of their own.
    """
    added = {"kept": "boolean", "rejected_by": "string", "n_tried": "int"}
    counts = {"n_words": "words", "word_chars": "word_chars", "n_symbols": "symbols", "n_dup_lines": "lines", "n_repeat_words": "repeated"}
    if report:
        added |= {c: "bigint" for c in counts} | {"base_failed": "boolean"}

    def judge(texts: pa.Array) -> list[pa.Array]:
        verdicts, found = [], []
        for value in texts.to_pylist():
            measured = Measured(value or "")
            tried = next((n for n, rule in enumerate(rules) if rule.rejects(measured)), None)
            name = None if tried is None else rules[tried].name
            verdicts.append((name is None, name, len(rules) if tried is None else tried + 1))
            if report:
                values = [measured[m][1] if m == "lines" else measured[m] for m in counts.values()]
                found.append((*values, any(r.rejects(measured) for r in rules if r.base)))
        kinds = [pa.bool_(), pa.string(), pa.int32()] + ([pa.int64()] * len(counts) + [pa.bool_()]) * report
        rows = [v + f for v, f in zip(verdicts, found)] if report else verdicts
        return [pa.array(values, kind) for values, kind in zip(zip(*rows) if rows else [[]] * len(kinds), kinds)]

    return with_columns(docs, text, added, judge, size=500_000)
