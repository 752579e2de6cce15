"""Language, quality, licence and chat operators: brute force, held-out accuracy and unusual rows."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpuskit.llm import language, licences, perspectives, quality

SMALL = "/root/testdata/sf0.01"
LONG = "a long word list " * 20_000


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, blanks, repeated rows, a long text, and columns named like those of the operators."""
    rows = [
        (1, None, None, 0.5, "x"),
        (2, "", "en", 0.5, None),
        (3, "  \n ", None, 0.5, "x"),
        (4, "12 34", "en", None, "x"),
        (5, "the MIT License and the mit license", "en", 0.5, "x"),
        (5, "the MIT License and the mit license", "en", 0.5, "x"),
        (None, "le chat est là", "fr", 0.5, "x"),
        (6, LONG, "en", 0.5, "x"),
        (7, "nul \x00 inside", "en", 0.5, "x"),
    ]
    return spark.createDataFrame(rows, "doc_id bigint, text string, lang string, score double, keep string")


def empty(df):
    return df.where("false")


# Language


def brute_bits(model_texts, text, order, min_count):
    """Code length by the definition: longest context first, an escape for every context that lacks the byte."""
    counts = {}
    for sample in model_texts:
        for i in range(len(sample)):
            for size in range(1, order + 2):
                if i + size <= len(sample):
                    counts[sample[i : i + size]] = counts.get(sample[i : i + size], 0) + 1
    followers = {}
    for string, n in counts.items():
        followers.setdefault(string[:-1], {})[string[-1]] = n
    known = {s for s, n in counts.items() if n >= min_count} | {b""}
    bits = 0.0
    for i, byte in enumerate(text):
        for size in range(min(i, order), -1, -1):
            context = text[i - size : i]
            if context not in known:
                continue
            after = followers.get(context, {})
            kept = {b: n for b, n in after.items() if context + bytes([b]) in known}
            total, q = sum(after.values()), len(kept)
            if byte in kept:
                bits -= math.log2(kept[byte] / (total + q))
                break
            if q:
                bits -= math.log2((total - sum(kept.values()) + q) / (total + q))
        else:
            bits += 8
    return bits


def test_code_lengths():
    rng = random.Random(3)
    samples = {
        "x": [bytes(rng.choice(b"abca") for _ in range(60)) for _ in range(4)],
        "y": [bytes(rng.choice(b"bccd ") for _ in range(50)) for _ in range(5)],
    }
    texts = samples["x"] + samples["y"]
    trees = language.grow(texts, [0] * 4 + [1] * 5, ["x", "y"], order=3, min_count=2)
    asked = [b"", b"a", b"abcabcab", b"zz", b"bcdz abc", bytes(rng.choice(b"abcdz ") for _ in range(40))]
    got = trees.code_lengths(asked)
    want = [[brute_bits(samples[name], text, 3, 2) for name in "xy"] for text in asked]
    assert np.allclose(got, want, atol=1e-3)


def test_language_accuracy(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    rest = F.crc32(F.col("doc_id").cast("string")) % 4
    rows = language.predicted(docs, language.learn(docs.where(rest != 2), rows=150)).where(rest == 2)
    right, total = rows.agg(F.count_if(F.expr("lang = lang_pred")), F.count("*")).first()
    assert total > 200 and right / total > 0.97


def test_language_odd_rows(spark, odd):
    trees = language.learn(odd, min_count=1)
    assert trees.languages == ["en", "fr"]
    rows = language.predicted(odd, trees)
    assert rows.columns == ["doc_id", "text", "lang", "keep", "lang_pred", "score"]
    found = {(r.doc_id, r.text): (r.lang_pred, r.score) for r in rows.collect()}
    assert rows.count() == 9
    assert [found[k] for k in ((1, None), (2, ""), (3, "  \n "), (4, "12 34"))] == [("und", 0.0)] * 4
    assert found[6, LONG][0] == "en" and found[None, "le chat est là"][0] == "fr"
    assert all(0 <= s <= 1 for _, s in found.values())
    assert language.learn(empty(odd)) is None
    assert language.predicted(empty(odd), None).count() == 0
    assert {r.lang_pred for r in language.predicted(odd, None).collect()} == {"und"}


def test_language_of_rows_with_one_id(spark):
    rows = [(n if lang == "many" else one, f"{lang} {n} {lang}", lang) for lang, one in [("many", 0), ("same", 7), ("none", None), ("also", 8)] for n in range(3_000)]
    rows += [(9, "copied text", "copies")] * 3_000
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    trees = language.learn(docs, rows=20, min_count=1)
    assert trees.languages == ["also", "copies", "many", "none", "same"]
    found = language.predicted(docs.where("doc_id is null or doc_id in (7, 8, 9)"), trees)
    assert found.where("lang_pred <> lang").count() == 0


def test_language_sample_does_not_depend_on_storage(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    a, b = language.learn(docs, rows=20), language.learn(docs.repartition(7, "n_chars"), rows=20)
    assert (a.cost == b.cost).all() and (a.child == b.child).all()


# Quality


def test_quality_accuracy(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    labels = spark.read.parquet(f"{SMALL}/labels.parquet")
    held = F.xxhash64("doc_id") % 3 == 0
    model = quality.learn(docs, quality.grades_of(labels.where(~held)))
    assert (np.diff(model.thresholds) > 0).all()
    rows = quality.graded(docs, model).join(labels.where(held), "doc_id")
    total, right, clean, kept = rows.agg(
        F.count("*"), F.count_if((F.col("quality") == 1) == F.col("keep")), F.count_if(F.expr("quality = 1")), F.count_if(F.expr("quality = 1 and keep"))
    ).first()
    assert total > 90 and right / total > 0.93 and kept / clean > 0.97
    by_grade = dict(rows.groupBy("quality").agg(F.avg("expected_grade")).collect())
    assert by_grade[0] < by_grade[1]


def test_quality_odd_rows(spark, odd):
    ratings = spark.createDataFrame([(4, 0), (5, 2), (5, 1), (6, 1), (None, 1), (9, 0), (7, None)], "doc_id bigint, grade int")
    model = quality.learn(odd, ratings)
    rows = quality.graded(odd, model)
    assert rows.columns == ["doc_id", "text", "lang", "score", "expected_grade", "tail_probability", "keep"]
    found = rows.collect()
    assert len(found) == 9 and all(0 <= r.tail_probability <= 1 for r in found)
    assert quality.learn(odd, ratings.where("doc_id = 9")) is None
    assert quality.learn(empty(odd), ratings) is None
    nothing = quality.graded(odd, None).collect()
    assert all(r.keep and r.expected_grade is None for r in nothing)
    assert quality.graded(empty(odd), model).count() == 0
    constant = quality.fit(["a", "b"], [1, 1])
    assert (constant.tails(["c"]) < 0.5).sum() + (constant.tails(["c"]) > 0.5).sum() == 1


# Licences


def test_matching_statistics():
    rng = random.Random(5)
    words = [f"w{i}" for i in range(6)]
    templates = [("t", " ".join(rng.choice(words) for _ in range(30))) for _ in range(4)]
    model = licences.TemplateAutomaton(templates, {"w1 w2": "p", "w2 w2 w3": "q"}, 3)
    texts = [licences.split_words(t) for _, t in templates] + [[b"w1", b"w2"], [b"w2", b"w2", b"w3"]]
    factors = {tuple(t[i:j]) for t in texts for i in range(len(t)) for j in range(i + 1, len(t) + 1)}
    stream = [rng.choice(words).encode() for _ in range(400)]
    got = [size for _, size in model.statistics([model.numbers[w] for w in stream])]
    want = [max((n for n in range(0, e + 1) if n == 0 or tuple(stream[e - n : e]) in factors)) for e in range(1, 401)]
    assert got == want
    base, _ = model.scan(stream, 3)
    places = [("p", i) for i in range(400) if stream[i : i + 2] == [b"w1", b"w2"]]
    places += [("q", i) for i in range(400) if stream[i : i + 3] == [b"w2", b"w2", b"w3"]]
    assert sorted(base) == sorted(places)


def test_licence_spans(spark, odd):
    mit = licences.TEMPLATES[0][1]
    texts = [
        (1, f"intro words here. {mit.replace('charge', 'cost')} and the end"),
        (2, "Permission is hereby granted"),
        (3, f"{mit} {mit}"),
    ]
    rows = {r.doc_id: r for r in licences.scan(spark.createDataFrame(texts, "doc_id int, text string")).collect()}
    (span,) = rows[1].spans
    assert (span.label, span.first) == ("mit", 3) and 0.9 < span.share < 1
    assert rows[2].spans == [] and rows[2].base == []
    assert [s.first for s in rows[3].spans] == [0, len(licences.split_words(mit))]
    found = licences.scan(odd).collect()
    assert len(found) == 9
    assert [(r.n_words, [(b.label, b.start) for b in r.base]) for r in found if r.doc_id == 5] == [(7, [("mit", 1), ("mit", 5)])] * 2
    assert [r.n_words for r in found if r.doc_id in (1, 2, 3)] == [0, 0, 0]
    assert licences.scan(empty(odd)).count() == 0


def test_overlapping_chains():
    # Two matches of template 0 with a word between them, one of another template inside, one far away.
    matches = [(0, 10, 0, 5), (0, 16, 6, 4), (1, 12, 3, 3), (0, 60, 0, 3)]
    assert sorted(licences.chains(matches, 4)) == [(0, 10, 19, 9), (0, 60, 62, 3), (1, 12, 14, 3)]


# Chat


def test_perspectives(spark):
    rows = [
        (1, 0, "system", "be kind", 9),
        (1, 1, "ann", "hi <|end|> there", 9),
        (1, 2, "bob", "hello", 9),
        (1, 3, "cy b", None, 9),
        (1, 4, "cy_b", "other", 9),
        (2, None, None, "x", 9),
        (3, 0, "system", "alone", 9),
        (None, 0, "ann", "no id", 9),
    ]
    turns = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string, perspective int")
    made = perspectives.segments(turns)
    found = {(r.conv_id, r.perspective): r for r in perspectives.examples(made).collect()}
    assert set(found) == {(1, "ann"), (1, "bob"), (1, "cy b"), (1, "cy_b"), (2, "unknown"), (None, "ann")}
    assert found[1, "bob"].text == (
        "<|system|>\nbe kind<|end|>\n<|user name=ann|>\nhi <\\|end|> there<|end|>\n<|assistant|>\nhello<|end|>\n<|user name=cy%20b|>\n<|end|>\n"
        "<|user name=cy_b|>\nother<|end|>\n"
    )
    for (_, who), row in found.items():
        said = [row.text[m["first"] : m["end"]] for m in row.mask]
        mine = {"ann": ["hi <\\|end|> there<|end|>"], "bob": ["hello<|end|>"], "cy b": ["<|end|>"], "cy_b": ["other<|end|>"], "unknown": ["x<|end|>"]}
        assert said == (["no id<|end|>"] if row.conv_id is None else mine[who])
    assert perspectives.segments(turns.where("false")).count() == 0
    back = spark.createDataFrame([("a<|b <\\| <\\\\|",)], "t string").select(
        perspectives.unescaped(perspectives.escaped(F.col("t"))).alias("u"), "t"
    )
    assert back.where("u = t").count() == 1


@pytest.mark.parametrize("turn", [None, 7])
def test_equal_turn_numbers_fall_into_many_stretches(spark, turn):
    turns = spark.range(3000).select(
        F.lit(1).cast("bigint").alias("conv_id"), F.lit(turn).cast("bigint").alias("turn"),
        F.when(F.col("id") % 2 == 0, "ann").otherwise("bob").alias("role"), F.format_string("%05d", "id").alias("text"),
    )
    made = perspectives.segments(turns)
    rows = sorted((r.start, r.chars, r.segment) for r in made.where("perspective = 'ann'").collect())
    assert [a for a, _, _ in rows] == [0, *[a + n for a, n, _ in rows[:-1]]]
    texts = [s.split("\n")[1][:5] for _, _, s in rows]
    assert texts == [f"{n:05d}" for n in [*range(0, 3000, 2), *range(1, 3000, 2)]]


def test_long_conversation(spark):
    turns = spark.range(2_000).select(
        F.lit(1).alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") % 3 == 0, "ann").otherwise("bob").alias("role"),
        F.expr("repeat('x', cast(id % 7 as int))").alias("text"),
    )
    for who, rows in groups(perspectives.segments(turns).collect()).items():
        rows.sort(key=lambda r: r.turn)
        at = 0
        for r in rows:
            assert r.start == at and r.chars == len(r.segment)
            at += r.chars
        parts = [p for p in perspectives.examples(perspectives.segments(turns), 5_000).collect() if p.perspective == who]
        assert len(parts) > 5 and "".join(p.text for p in sorted(parts, key=lambda p: p.part)) == "".join(r.segment for r in rows)


def groups(rows):
    found = {}
    for r in rows:
        found.setdefault(r.perspective, []).append(r)
    return found
