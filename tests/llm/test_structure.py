"""Conversation repair, filter interactions and the rule cascade against brute force and on odd tables."""

import hashlib
import random
import re
import zlib
from collections import Counter
from functools import lru_cache
from itertools import permutations

from pyspark.sql import functions as F

from corpuskit.llm import filter_audit, rule_cascade, text_figures, turn_repair

BLANK = re.compile(r"[^\x20\x09-\x0D]")


def best_edits(codes):
    """(cost, audit) over all edits, by plain recursion over suffixes."""

    @lru_cache(None)
    def best(n, state, inserted):
        ways = [(0, "")] if n == len(codes) and state in (0, 3) else []
        if inserted < 4:
            cost, audit = best(n, turn_repair.AFTER_INSERT[state], inserted + 1)
            ways.append((cost + 3, "I" + audit))
        if n < len(codes):
            kind, fault = divmod(codes[n], 4)
            cost, audit = best(n + 1, state, 0)
            ways.append((cost + 4, "D" + audit))
            if fault < 2:
                speaker = turn_repair.AFTER_INSERT[state]
                cost, audit = best(n + 1, speaker, 0)
                ways.append((cost + 3 + 3 * fault, "R" + audit))
                if kind < 3 and (kind + 1 == speaker or kind == state == 0):
                    cost, audit = best(n + 1, kind + 1, 0)
                    ways.append((cost + 3 * fault, "K" + audit))
        return min(ways, default=(1 << 50, ""))

    return best(0, 0, 0)


def test_divide_and_conquer_finds_the_least_edits():
    draw = random.Random(5)
    for _ in range(3000):
        codes = [draw.choice([4, 8, 4, 8, 0, 5, 9, draw.randrange(16)]) for _ in range(draw.randint(1, 10))]
        tables = [turn_repair.TABLES[c] for c in codes]
        whole = turn_repair.combined(tables)
        last = turn_repair.last_state(whole)
        audit = "".join(e for _, e in turn_repair.row_edits(codes, 0, last)) + turn_repair.CLOSING[last]
        assert (whole[0][0][last] + 3 * len(turn_repair.CLOSING[last]), audit) == best_edits(tuple(codes))
        size = draw.randint(1, len(codes))
        parts = [turn_repair.combined(tables[a : a + size]) for a in range(0, len(codes), size)]
        assert turn_repair.combined(parts) == whole
        states = turn_repair.crossings(parts, 0, last)
        pieces = [turn_repair.row_edits(codes[n * size : n * size + size], a, b) for n, (a, b) in enumerate(zip(states, states[1:]))]
        assert "".join(e for p in pieces for _, e in p) + turn_repair.CLOSING[last] == audit


def plain_report(rows):
    """The figures of one conversation from its rows (turn, role, text) after damage."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
    seen, codes, faults, illegal = set(), [], Counter(), 0
    for n, (_, role, text) in enumerate(rows):
        marks = BLANK.findall(text)
        fault = 2 if not marks else 3 if (role, text) in seen else 1 if marks[-1] not in ".!?" else 0
        seen.add((role, text))
        faults[fault] += 1
        codes.append(max("sua".find(role[:1]) if role else -1, -1) % 4 * 4 + fault)
        illegal += n > 0 and rows[n - 1][1][:1] + role[:1] not in ("su", "ua", "au")
    turns = [t for t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    cost, audit = best_edits(tuple(codes))
    state, lines, left = 0, [], iter(rows)
    for edit in audit:
        if edit == "I":
            state = turn_repair.AFTER_INSERT[state]
            lines.append(("user" if state == 2 else "assistant") + ":")
            continue
        _, role, text = next(left)
        if edit == "R":
            state = turn_repair.AFTER_INSERT[state]
            role = "user" if state == 2 else "assistant"
        elif edit == "K":
            state = "sua".index(role[0]) + 1
        if edit != "D":
            lines.append(f"{role}:{text}")
    return gaps, faults[2], faults[3], faults[1], illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest(), lines


ODD = [
    (1, None, "system", "Be kind."), (1, 1, "user", "Hello!"), (1, 1, "user", "Hello!"), (1, 2, "assistant", "Hi"), (1, 9, "tool", "x."),
    (None, 1, None, None), (None, 2, "user", "Who?"), (None, None, "assistant", "Me."),
    (2, 5, "user", "a." * 700_000), (2, 6, "assistant", ""), (3, 1, "", "Odd."), (3, 4, "sally", "Odd."), (4, None, "user", None),
]


def test_repair_of_odd_conversations(spark):
    turns = spark.createDataFrame([(*r, "x", 1) for r in ODD], "conv_id bigint, turn bigint, role string, text string, state string, codes int")
    extra = spark.createDataFrame([(7,)], "conv_id bigint")
    said = turns.select("conv_id", "turn", "role", "text")
    for fan in (1024, 2):
        walked = turn_repair.repaired(turns.select("conv_id").union(extra), said, fan)
        found = {r[0]: tuple(r)[1:] for r in turn_repair.report(walked).collect()}
        texts = {}
        for r in turn_repair.repaired_turns(walked).collect():
            texts.setdefault(r.conv_id, []).append((r.place, f"{r.role}:{r.text}"))
        for conv in (1, None, 2, 3, 4):
            rows = [(t, " " if r is None else r, " " if x is None else x) for c, t, r, x in ODD if c == conv]
            want = plain_report(rows)
            assert found[conv] == (*want[:8], len(rows))
            assert [t for _, t in sorted(texts.get(conv, []))] == want[8]
        assert found[7] == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest(), 0)
    none = turns.where("false")
    assert turn_repair.report(turn_repair.repaired(none, turn_repair.damaged(none))).count() == 0


def test_damage(spark):
    rows = [(c, t, "assistant", f"Yes! {c} no.") for c in [None, *range(30)] for t in [None, *range(8)]]
    want = []
    for c, t, role, text in rows:
        way = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        if way:
            text = "" if way == 1 else re.sub("[.!?]", "", text) if way == 2 else text
            want += [(c, t, "user" if way == 4 else role, text)] * (2 if way == 3 else 1)
    got = turn_repair.damaged(spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string"))
    assert Counter(map(tuple, got.collect())) == Counter(want)


def test_one_long_conversation_is_solved_in_stretches(spark):
    draw = random.Random(2)
    rows = [(n // 3, draw.choice(["user", "assistant"]), f"{draw.choice('ab')}{draw.randrange(1500)}{draw.choice('.. ')}") for n in range(4000)]
    turns = spark.createDataFrame([(5, *r) for r in rows], "conv_id bigint, turn bigint, role string, text string")
    numbered = turn_repair.numbered(turns)
    assert turn_repair.stretches(numbered).count() > 3
    few, many = (turn_repair.report(turn_repair.repaired(turns, turns, fan)).collect() for fan in (2, 1024))
    assert few == many and few[0].n_rows == 4000
    ordered = sorted(rows)
    codes, seen = [], set()
    for _, role, text in ordered:
        fault = 3 if (role, text) in seen else 0 if text.strip()[-1] == "." else 1
        seen.add((role, text))
        codes.append("sua".index(role[0]) * 4 + fault)
    tables = [turn_repair.TABLES[c] for c in codes]
    assert few[0].cost == min(c + 3 * len(e) for c, e in zip(turn_repair.combined(tables)[0][0], turn_repair.CLOSING))
    assert (few[0].duplicate, few[0].truncated) == (sum(c % 4 == 3 for c in codes), sum(c % 4 == 1 for c in codes))


TEXTS = [
    None, "", " \n\t", "one two three four", "A" * 5 + " b", "spam spam spam " * 120, "Word é ü " * 100, "x #tag", "one\ntwo\none\n\n two\none",
    "long words in a text that never ends\n" * 40_000, "unique " + " ".join(f"w{n}" for n in range(260)), "a\x0bb\x1cc d",
]


def plain_words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text)


def test_figures_of_texts():
    for text in [t or "" for t in TEXTS]:
        words = plain_words(text)
        assert text_figures.words_and_distinct(text) == (len(words), len(set(words)))
        windows = Counter(zip(words, words[1:], words[2:]))
        covered = {n + k for n, w in enumerate(zip(words, words[1:], words[2:])) if windows[w] > 1 for k in range(3)}
        assert text_figures.repeated_words(text) == len(covered)
        lines = [line for line in text.split("\n") if plain_words(line)]
        assert text_figures.line_counts(text) == (len(lines), len(lines) - len(set(lines)))
        assert "".join(text_figures.pieces(text, 7)) == text
        assert [w for p in text_figures.pieces(text, 7) for w in plain_words(p)] == words


def test_many_distinct_words_need_two_steps(monkeypatch):
    words = [f"w{n}" for n in range((1 << 21) + 5)] + ["w1", "w2", "w3", "w9"]
    assert text_figures.repeated_words(" ".join(words)) == 6


def test_cascade_on_odd_texts(spark):
    rows = [(n, t, "c0", True) for n, t in enumerate(TEXTS)] * 2 + [(None, "x", None, None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, c0 string, kept boolean")
    orders = [rule_cascade.plan(docs), rule_cascade.RULES, rule_cascade.RULES[::-1]]
    results = []
    for order in orders:
        found = rule_cascade.judged(docs, order, report=True)
        assert found.columns[:3] == ["doc_id", "text", "c0"] and set(order) == set(rule_cascade.RULES)
        results.append(sorted((repr((r.doc_id, r.kept, r.base_failed, r.n_words, r.word_chars, r.n_symbols)) for r in found.collect())))
        for r in found.collect():
            measured = rule_cascade.Measured(r.text or "")
            failing = [rule.name for rule in order if rule.rejects(measured)]
            assert r.kept == (not failing) and r.rejected_by == (failing or [None])[0]
            assert r.n_tried == (len(order) if r.kept else [x.name for x in order].index(failing[0]) + 1)
            assert r.word_chars == len("".join(plain_words(r.text or ""))) and r.n_words == len(plain_words(r.text or ""))
            assert not (r.base_failed and r.kept)
    assert results[0] == results[1] == results[2]
    assert rule_cascade.judged(docs.where("false"), rule_cascade.plan(docs.where("false"))).count() == 0


def test_cascade_order_is_rejection_per_cost():
    rules = rule_cascade.RULES[:3]
    cost = {"words": 10, "repeated": 1000, "symbols": 1}
    tried = [(cost, [True, True, False])] * 5 + [(cost, [False, True, True])] * 3 + [(cost, [False, False, False])] * 9
    # few_words: 5 for 10; symbols: 3 for 11; repeated_windows: 8 for 1010.
    assert [r.name for r in rule_cascade.ordered(tried, rules)] == ["few_words", "symbols", "repeated_windows"]


def plain_audit(docs, labels):
    """All rows of the audit by running every order over every document."""
    least = {}
    for doc_id, text, _ in docs:
        if doc_id is not None:
            least[text or ""] = min(least.get(text or "", doc_id), doc_id)
    rows = []
    for doc_id, text, part in docs:
        text = text or ""
        words = plain_words(text)
        fails = {
            "A": len(words) < 200, "B": 100 * len(set(words)) < 50 * len(words), "C": 100 * len(re.findall("[A-Z]", text)) > 2 * len(text),
            "D": bool(re.search("[#$%&*|]", text)), "E": doc_id is not None and doc_id > least[text],
        }
        rows.append((part or "", fails, *[any(i is not None and i == doc_id and flags[k] == 1 for i, *flags in labels) for k in (0, 1)]))
    out = {}
    for part in {r[0] for r in rows}:
        mine = [r for r in rows if r[0] == part]
        shapley = Counter()
        for order in permutations("ABCDE"):
            for n, letter in enumerate(order):
                alive = [r for r in mine if not any(r[1][x] for x in order[:n])]
                removed = [r for r in alive if r[1][letter]]
                failing = sum(r[1][letter] for r in mine)
                only = sum(r[1][letter] and sum(r[1].values()) == 1 for r in mine)
                shapley[letter] += len(removed)
                out[part, "".join(order), n + 1] = [len(alive) - len(removed), len(removed), failing - len(removed), only, sum(r[2] for r in removed), sum(r[3] for r in removed)]
        for (p, order, step), figures in out.items():
            if p == part:
                figures.append(shapley[order[step - 1]])
    return out


def test_audit_of_odd_documents(spark):
    docs = [(n, t, "x" if n % 3 else None) for n, t in enumerate(TEXTS)] + [(n + 100, t, "y") for n, t in enumerate(TEXTS)]
    docs += [(3, TEXTS[3], "x")] * 3 + [(None, TEXTS[3], "x")] * 2 + [(3, "other text", "")]
    labels = [(n, n % 2, n % 3) for n in range(8)] + [(3, 0, 1), (None, 1, 1), (5, None, None)]
    frame = spark.createDataFrame([(*d, "m") for d in docs], "doc_id bigint, text string, source string, mask string")
    marks = spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")
    want = plain_audit(docs, labels)
    got = filter_audit.audit(frame, marks).collect()
    assert len(got) == len(want)
    names = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    for r in got:
        assert [r[n] for n in names] == want[r.part, r.filter_order, r.step]
    assert filter_audit.audit(frame.where("false"), marks).count() == 0
    assert {r.part: r.n for r in filter_audit.mask_counts(filter_audit.failures(frame), marks.where("false")).groupBy("part").agg(F.sum("n").alias("n")).collect()} == Counter(d[2] or "" for d in docs)


def test_sketch_clears_only_unique_texts(spark):
    docs = spark.range(30_000).selectExpr("id as doc_id", "concat('t', if(id % 10 = 0, id % 100, id)) as text", "'s' as source")
    rows = filter_audit.masks(docs)
    times = Counter(r.hash for r in rows.collect())
    for most in (filter_audit.SKETCH_BYTES, 1 << 17):
        sketch = filter_audit.sketch_of(rows, most)
        tested = rows.withColumn("again", filter_audit.tester(docs, sketch)("hash")).collect()
        assert all(r.again for r in tested if times[r.hash] > 1)
        cleared = sum(not r.again for r in tested)
        assert cleared > 0.97 * sum(n == 1 for n in times.values()) if most > 1 << 20 else sketch.bits == 19
