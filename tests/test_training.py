import math
import time

import brute
import numpy as np
import pyarrow as pa
import pytest
from conftest import SMALL
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from corpuskit.config import SPECIAL_TOKENS, WORDPIECE_SPECIAL_TOKENS
from corpuskit.functions import lattice, subwords, text as tx
from corpuskit.operators import counts as ct
from corpuskit.operators import losses as ls
from corpuskit.operators import merge_training as mt
from corpuskit.operators import tokenizers as tk
from corpuskit.operators import unigram as ug
from corpuskit.plans import training_queries
from corpuskit.session import cut_lineage


def merges_of(model):
    return [(r["left"], r["right"], r["merged"]) for r in model.merges.orderBy("rank").collect()]


def ids_of(model):
    return {r["token"]: r["id"] for r in model.vocab.collect()}


def docs_of(spark, *texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")


def test_bpe_by_hand(spark):
    model = tk.train_bpe(docs_of(spark, "aaab aab"), 100)
    assert merges_of(model) == [("a", "a", "aa"), ("aa", "a", "aaa"), ("aaa", "b", "aaab"), ("aa", "b", "aab")]
    ids = ids_of(model)
    assert [ids[t] for t in (" ", "a", "b", "aa", "aaa", "aaab", "aab")] == list(range(4, 11))


def test_wordpiece_by_hand(spark):
    model = tk.train_wordpiece(docs_of(spark, "ab ab cb"), 100)
    assert [m[2] for m in merges_of(model)] == ["ab", "cb"]
    ids = ids_of(model)
    assert [ids[t] for t in ("##b", "a", "c", "ab", "cb")] == [7, 8, 9, 10, 11]
    tokens = docs_of(spark, "cab").select(model.tokens(F.col("text")).alias("t")).first()["t"]
    assert tokens == ["c", "<UNK>", "##b"]


def test_bpe_against_brute_force(corpus, texts):
    types = brute.tallies(brute.word_list(texts, keep_space=True))
    expected = brute.learn([(w, f) for w, f in types.items()], 60)
    n_symbols = len({c for t in texts for c in t}) + len(SPECIAL_TOKENS)
    assert merges_of(tk.train_bpe(corpus, n_symbols + 60)) == expected


def test_wordpiece_against_brute_force(corpus, texts):
    types = brute.tallies(brute.word_list(texts))
    pieces = [([w[0], *("##" + c for c in w[1:])], f) for w, f in types.items()]
    expected = brute.learn(pieces, 60, by_score=True, prefix="##")
    n_symbols = len({p for t, _ in pieces for p in t}) + len(WORDPIECE_SPECIAL_TOKENS)
    assert merges_of(tk.train_wordpiece(corpus, n_symbols + 60)) == expected


@pytest.mark.parametrize("kind", ["bpe", "wordpiece"])
def test_merge_training_does_not_depend_on_guesses(corpus, monkeypatch, kind):
    from corpuskit.operators import merge_training as mt

    train = getattr(tk, f"train_{kind}")
    expected = merges_of(train(corpus, 85))
    # A poor sample, few pairs on the driver, short lists, and a new word table every few merges.
    for name, value in {"GUESS_WORDS": 5, "GUESS_TOP": 3, "PAIRS_HELD": 4, "FEWEST_GUESSES": 6, "REBASE_AFTER": 5, "BLOCK_SYMBOLS": 40, "NEAR_TOP": 1}.items():
        monkeypatch.setattr(mt, name, value)
    assert merges_of(train(corpus, 85)) == expected


@pytest.mark.parametrize("kind", ["bpe", "wordpiece"])
def test_a_thousand_tokens_on_the_given_documents(spark, kind):
    """All merges as by counting anew after each, on the smallest documents; the word table is rewritten on the way."""
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text")
    texts = [r.text for r in docs.orderBy("doc_id").collect()]
    types = brute.tallies(brute.word_list([t or "" for t in texts], keep_space=kind == "bpe"))
    if kind == "bpe":
        words, prefix, special = [(list(w), f) for w, f in types.items()], "", SPECIAL_TOKENS
    else:
        words, prefix, special = [([w[0], *("##" + c for c in w[1:])], f) for w, f in types.items()], "##", WORDPIECE_SPECIAL_TOKENS
    model = getattr(tk, f"train_{kind}")(docs, 1000)
    got = merges_of(model)
    assert model.vocab.count() == 1000 and len(got) > 2 * 256
    assert got == brute.learn_indexed(words, len(got), kind == "wordpiece", prefix)


def test_sentencepiece_bpe_against_brute_force(corpus, texts):
    types = brute.tallies("▁" + w for w in brute.word_list(texts))
    expected = brute.learn([(w, f) for w, f in types.items()], 30)
    symbols = {c for w in types for c in w}
    model = tk.train_sentencepiece(corpus, len(symbols) + len(SPECIAL_TOKENS) + 30, "BPE")
    assert merges_of(model) == expected
    with pytest.raises(ValueError):
        tk.train_sentencepiece(corpus, 100, "words")


def test_seed_subwords_and_pruning_against_brute_force(corpus, texts):
    types = brute.tallies(brute.word_list(texts))
    counts, total = {}, 0
    for w, f in types.items():
        for i in range(len(w)):
            for j in range(i + 1, min(i + 16, len(w)) + 1):
                counts[w[i:j]] = counts.get(w[i:j], 0) + f
                total += f
    order = sorted(counts, key=lambda t: -counts[t])[:120]
    seeds = ct.seed_subwords(ct.stripped_word_counts(corpus), 120)
    got = [(r["token"], r["freq"]) for r in seeds.orderBy("seed_rank").collect()]
    assert got == [(t, counts[t]) for t in order]
    logp = {t: math.log(counts[t] / total) for t in order}
    unigram = ug.prune(ct.stripped_word_counts(corpus), seeds, 60, SPECIAL_TOKENS, 0.2)
    expected = brute.pruned(types, logp, 60, SPECIAL_TOKENS, 0.2)
    assert {r["token"] for r in unigram.collect()} == set(expected)
    loss = ug.corpus_loss(ct.stripped_word_counts(corpus), expected).first()["loss"]
    assert loss == pytest.approx(brute.loss(types, expected))


def test_importance_against_brute_force(corpus, texts):
    types = brute.tallies(brute.word_list(texts))
    seeds = ct.seed_subwords(ct.stripped_word_counts(corpus), 90)
    logp = ug.model_dict(seeds)
    got = {r["token"]: r["importance"] for r in ug.token_importance(ct.stripped_word_counts(corpus), logp).collect()}
    base = brute.loss(types, logp)
    for token in logp:
        if len(token) > 1:
            change = brute.loss(types, {k: v for k, v in logp.items() if k != token}) - base
            assert got.get(token, 0.0) == pytest.approx(change, abs=1e-6)


@pytest.mark.parametrize("numbers", [40, 100_000])
@given(st.lists(st.text("abcé𝒳", min_size=1, max_size=24), min_size=1, max_size=30, unique=True), st.dictionaries(st.text("abcé𝒳", min_size=1, max_size=18), st.sampled_from([-1.0, -2.0, -3.3, -4.0]), max_size=30))
@settings(max_examples=60, deadline=None)
def test_words_walked_together_gain_what_each_gains_alone(numbers, words, logp):
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(lattice, "TABLE_NUMBERS", numbers)
        patch.setattr(lattice, "TREE_NUMBERS", numbers)
        pieces, freq = lattice.Pieces(logp), np.arange(1, len(words) + 1)
        got, expected = [], []
        for n in lattice.by_length(words, len(pieces.codes), 64):
            some = [words[x] for x in n.tolist()]
            for piece, gain in lattice.gains(pieces, some, freq[n], lambda w: -ug.path_loss(list(w), logp)):
                got += zip([pieces.tokens[x] for x in piece.tolist()], gain.tolist())
    for word, f in zip(words, freq.tolist()):
        expected += ug.word_gains(word, f, logp).items()
    assert sorted(got) == sorted(expected)


@given(st.lists(st.text("abcé𝒳 ", max_size=24) | st.text("ab", min_size=60, max_size=70), max_size=30), st.dictionaries(st.text("abcé𝒳", min_size=1, max_size=18), st.sampled_from([-1.0, -2.0, -3.3, -4.0]), max_size=30))
@settings(max_examples=100, deadline=None)
def test_words_cut_together_are_cut_as_alone(words, logp):
    segment = subwords.unigram_segmenter(logp)
    assert segment.many(words) == [segment(w) for w in words]
    assert subwords.cached(segment).many(words) == [segment(w) for w in words]


def test_pruning_writes_the_words_once(spark, corpus, monkeypatch):
    """What each word gains was written anew in every round."""
    written = []
    monkeypatch.setattr(ug, "cut_lineage", lambda df: written.append(df.columns) or cut_lineage(df))
    types = ct.stripped_word_counts(corpus)
    seeds = ct.seed_subwords(types, 120)
    assert ug.prune(types, seeds, 60, SPECIAL_TOKENS, 0.1).count() == 60
    assert written == [["word", "freq"]]


def test_importance_of_tokens_in_long_words(spark):
    logp = {"a": -1.0, "b": -2.0, "ab": -1.5, "ba": -2.5, "abab": -3.1}
    words = [("ab" * 50, 3), ("abba", 2), ("b" * 70, 1), ("", 4), ("xab", 5)]
    rows = spark.createDataFrame([(w, f, n) for n, (w, f) in enumerate(words)], "word string, freq bigint, first bigint")
    expected = {}
    for word, f in words:
        for token, gain in ug.word_gains(word, f, logp).items():
            expected[token] = expected.get(token, 0.0) + gain
    got = {r["token"]: r["importance"] for r in ug.token_importance(rows, logp).collect()}
    assert got == pytest.approx(expected)


@pytest.mark.parametrize("cross_word", [True, False])
def test_sentencepiece_unigram(corpus, cross_word):
    model = tk.train_sentencepiece(corpus, 60, "unigram", cross_word=cross_word)
    ids = ids_of(model)
    assert sorted(ids.values()) == list(range(len(ids)))
    if cross_word:
        spans = [t for t in ids if "▁" in t[1:]]
        seeds = ct.seed_subwords(ug.line_counts(corpus), 600)
        assert seeds.where("token like '_%▁%'").count() > 0, spans


def test_round_trips(corpus, texts):
    bpe = tk.train_bpe(corpus, 90)
    got = {r["doc_id"]: r["text"] for r in bpe.decode(bpe.encode(corpus)).collect()}
    assert got == dict(enumerate(texts))
    joined = {i: " ".join(t.split()) for i, t in enumerate(texts)}
    for model in (tk.train_sentencepiece(corpus, 90), tk.train_wordpiece(corpus, 130)):
        got = {r["doc_id"]: r["text"] for r in model.decode(model.encode(corpus)).collect()}
        assert got == joined


def test_encode_options(corpus):
    model = tk.train_bpe(corpus, 60)
    rows = model.encode(corpus, max_length=6, padding=True, add_special=True).collect()
    assert all(len(r["input_ids"]) == 6 and r["input_ids"][0] == 2 for r in rows)
    batch = model.encode_batches(corpus.withColumn("batch_id", F.lit(0)), max_length=5).collect()
    assert {len(r["input_ids"]) for r in batch} == {5}
    assert {r["doc_id"]: sum(r["attention_mask"]) for r in batch}[3] == 0


@given(st.text("ab", max_size=9), st.lists(st.tuples(st.text("ab", min_size=1, max_size=3), st.text("ab", min_size=1, max_size=3)), max_size=6, unique=True))
@settings(max_examples=300, deadline=None)
def test_bpe_segmenter_applies_merges_in_order(word, merges):
    tokens = list(word)
    for pair in merges:
        tokens = brute.glue(tokens, pair, pair[0] + pair[1])
    assert subwords.bpe_segmenter({p: i for i, p in enumerate(merges)})(word) == tokens


@given(st.text("abc", max_size=8), st.dictionaries(st.text("abc", min_size=1, max_size=4), st.integers(-9, -1).map(float), max_size=10))
@settings(max_examples=300, deadline=None)
def test_unigram_segmenter_finds_the_best_split(word, logp):
    assert subwords.unigram_segmenter(logp)(word) == brute.best_split(word, logp)


def test_viterbi_by_hand():
    segment = subwords.unigram_segmenter({"a": -1.0, "b": -1.0, "ab": -2.5})
    assert segment("ab") == ["a", "b"]
    assert segment("abz") == ["a", "b", "<UNK>"]
    assert subwords.unigram_segmenter({"a": -1.0, "b": -1.0, "ab": -2.0})("ab") == ["ab"]


def test_wordpiece_segmenter():
    segment = subwords.wordpiece_segmenter(frozenset({"un", "##aff", "##able", "a", "##a"}))
    assert segment("unaffable") == ["un", "##aff", "##able"]
    assert segment("xa") == ["<UNK>", "##a"]


def test_substring_expression(spark):
    row = spark.createDataFrame([("abc",)], "w string").select(tx.substrings(F.col("w"), 2).alias("s")).first()
    assert row["s"] == ["a", "ab", "b", "bc", "c"]


def test_ids_of_any_size_give_the_same_training(spark, corpus):
    far = corpus.withColumn("doc_id", (F.col("doc_id") - 3) * F.lit(2**60) + F.col("doc_id"))
    for train in (tk.train_bpe, tk.train_wordpiece):
        near_model, far_model = train(corpus, 60), train(far, 60)
        assert near_model.merges.collect() == far_model.merges.collect()
    near_seeds, far_seeds = (ct.seed_subwords(ct.stripped_word_counts(d), 40).collect() for d in (corpus, far))
    assert sorted(near_seeds) == sorted(far_seeds)


def test_consecutive_groups_go_by_rows(spark):
    rows = spark.createDataFrame([(7 * n - 10**15, float(n % 3)) for n in range(10)], "seq bigint, reward double").repartition(3)
    got = {r["seq"]: r["advantage"] for r in ls.consecutive_advantages(rows, 4).collect()}
    for start in (0, 4):
        rewards = [n % 3 for n in range(start, start + 4)]
        mean = sum(rewards) / 4
        std = (sum((x - mean) ** 2 for x in rewards) / 3) ** 0.5
        for n, x in zip(range(start, start + 4), rewards):
            assert abs(got[7 * n - 10**15] - (x - mean) / (std + 1e-8)) < 1e-9
    assert got[56 - 10**15] == got[63 - 10**15] == 0


def test_word_vectors_train_on_words_met_twice(spark):
    docs = training_queries.documents(spark, SMALL)
    words = docs.select(F.explode(tx.letter_words(F.col("text"))).alias("token")).groupBy("token").count().where("count >= 2")
    vocab, size, ids = training_queries.training_pairs(spark, SMALL)
    assert {r.token for r in words.collect()} <= {r.token for r in vocab.collect()}
    met = ids.select(F.sum(F.size("input_ids"))).first()[0]
    assert met == words.agg(F.sum("count")).first()[0] and size >= words.count()


@pytest.mark.parametrize("kind", ["sentencepiece-bpe", "sentencepiece-unigram"])
def test_fixed_models_through_files(spark, tmp_path, kind):
    from corpuskit.plans import model_queries as mq
    from corpuskit.sources import models

    model = mq.fixed(spark, kind)
    models.write_json(model, str(tmp_path / "model"))
    back = models.read_json(spark, str(tmp_path / "model"))
    assert back.kind == kind
    if kind.endswith("bpe"):
        assert merges_of(back) == [(a, b, a + b) for a, b in mq.MARKED_MERGES]
    else:
        assert {r.token: r.logp for r in back.unigram.collect()} == mq.MARKED_LOGP


@pytest.mark.parametrize("block", [7, 1000])
def test_suffixes_of_a_block_against_brute_force(monkeypatch, block):
    monkeypatch.setattr(ct, "BLOCK_CHARS", block)
    words = ["abababab", "été 中文中文", "a", "", "bababbbab", "中文"]
    table = pa.table({"word": words, "freq": [3, 2, 5, 1, 1, 4], "first": [4, 0, 1, 2, 3, 5]})

    def brute(known, size):
        found = {}
        for word, freq, first in zip(*(table.column(c).to_pylist() for c in table.column_names)):
            for at in range(len(word)):
                end = min(len(word), at + size)
                if known:
                    n = len(known[0])
                    run = next((k for k in range(len(word)) if word[at + k : at + k + n] not in known), len(word))
                    end = min(end, at + n + run - 1) if run else at
                if end > at + (len(known[0]) if known else 0):
                    old = found.get(word[at:end], (0, first))
                    found[word[at:end]] = (old[0] + freq, min(old[1], first))
        return found

    for known, size in ((None, 5), (["ab", "ba", "中文"], 4), (["文中", "ba"], 6)):
        levels = ct.beginning_codes(known) if known else None
        got = {}
        for batch in ct.block_suffixes(table, size, levels):
            for suffix, freq, first in zip(*(batch.column(c).to_pylist() for c in range(3))):
                old = got.get(suffix, (0, first))
                got[suffix] = (old[0] + freq, min(old[1], first))
        assert got == brute(known, size)


def test_seeds_of_a_long_line_take_time_in_proportion(spark):
    line = "".join(f"word{n % 977} " for n in range(60_000))
    types = spark.createDataFrame([(line, 1, 0)], "word string, freq bigint, first bigint")
    begin = time.monotonic()
    found = {r["token"]: r["freq"] for r in ct.frequent_substrings(types, 50).collect()}
    assert time.monotonic() - begin < 25  # cutting each suffix from the start of the line took minutes
    assert found["word"] == line.count("word") and len(found) >= 50


def test_texts_are_cut_alike_in_both_engines(spark):
    points = [chr(n) for n in range(1, 0x30000) if not 0xD800 <= n < 0xE000]
    texts = ["".join(points), "a".join(points), "", " 　a\x1c\x85b​ ", " "]
    docs = docs_of(spark, *texts)
    rows = docs.select("doc_id", tx.words(F.col("text")).alias("w"), tx.chunks(F.col("text")).alias("c")).collect()
    for row in rows:
        assert row["w"] == tx.split_words(texts[row["doc_id"]])
        assert row["c"] == tx.split_chunks(texts[row["doc_id"]])
    for size in (1, 3, 50):
        for text in texts:
            parts = list(tx.pieces(text, size))
            assert [w for p in parts for w in tx.split_words(p)] == tx.split_words(text)
            assert [c for p in parts for c in tx.split_chunks(p)] == tx.split_chunks(text)


def test_blocks_of_texts_count_before_the_shuffle(spark):
    """Null texts, null ids, repeated ids and ids out of order; few rows leave a block."""
    rows = [(7, "b a b"), (None, "c  b"), (-5, " a\td"), (7, "e a"), (3, None), (2**62, "f b")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").coalesce(1)
    for fast, tokens in ((ct.chunk_counts, tx.chunks), (ct.stripped_word_counts, tx.words)):
        slow = ct.count_tokens(docs, tokens(F.col("text")))
        assert sorted(map(str, fast(docs).collect())) == sorted(map(str, slow.collect()))
    plan = ct.chunk_counts(docs)._jdf.queryExecution().toString()
    assert "Generate" not in plan  # before, every token was a row of its own


def test_segmented_texts_give_the_tokens_of_their_words(corpus, texts):
    nulls = corpus.unionByName(corpus.limit(1).selectExpr("99L as doc_id", "cast(null as string) as text"))
    for model in (tk.train_bpe(corpus, 60), tk.train_wordpiece(corpus, 60), tk.train_sentencepiece(corpus, 60, "bpe")):
        both = nulls.select(model.tokens(F.col("text")).alias("a"), model.segmenter()(model.words(F.col("text"))).alias("b")).collect()
        assert len(both) == len(texts) + 1 and all(r["a"] == r["b"] for r in both)
        plan = nulls.select(model.tokens(F.col("text")))._jdf.queryExecution().toString()
        assert "split" not in plan and "regexp_extract_all" not in plan


def test_words_sent_for_wordpiece_guesses_are_bounded(corpus, monkeypatch):
    sent = []
    whole = mt.MergeTrainer.words_with

    def counted(self, codes):
        found = whole(self, codes)
        sent.append(len(found.freq) if found is not None else 0)
        return found

    monkeypatch.setattr(mt.MergeTrainer, "words_with", counted)
    for name, value in (("SENT_WORDS", 24), ("SENT_AT_LEAST", 2), ("FEWEST_GUESSES", 3), ("MOST_GUESSES", 3)):
        monkeypatch.setattr(mt, name, value)
    types = ct.stripped_word_counts(corpus)
    args = tx.wordpiece_characters, 12, WORDPIECE_SPECIAL_TOKENS, tx.WORDPIECE_PREFIX, True
    merges = mt.first_merges(types, *args).collect()
    assert len(merges) == 12 and sum(sent) <= 24 + 2 * len(sent) and max(sent) <= 3 and len(sent) > 2
    monkeypatch.undo()
    assert mt.first_merges(types, *args).collect() == merges


@pytest.mark.parametrize("kind", ["bpe", "wordpiece", "sentencepiece-bpe", "sentencepiece-unigram"])
@pytest.mark.parametrize("items", [7, 4_000_000])
def test_ids_and_texts_are_made_in_slices(spark, monkeypatch, kind, items):
    """Tokens went to Spark and back as lists of strings, ten thousand texts at a time."""
    from corpuskit.operators import encode as en
    from corpuskit.plans.model_queries import fixed

    monkeypatch.setattr(en, "SLICE_ITEMS", items)
    model = fixed(spark, kind)
    texts = ["the thin  ant", None, "", "and ##the zé the\tother", " ", "##", "then " * 9]
    docs = spark.createDataFrame([(n, t) for n, t in enumerate(texts)] + [(None, "ant")], "key bigint, text string").coalesce(1)
    encoded = model.encode(docs, doc_id="key", add_special=True)
    by_tokens = en.encode_tokens(docs, model.tokens(F.col("text")), model.vocab, doc_id="key")
    first, last = model.marker_ids
    want = {r["doc_id"]: [first, *r["input_ids"], last] for r in by_tokens.collect()}
    assert {r["doc_id"]: r["input_ids"] for r in encoded.collect()} == want
    shifted = encoded.withColumn("input_ids", F.concat(F.array(F.lit(9999), F.lit(None).cast("int")), "input_ids"))
    shifted = shifted.union(spark.createDataFrame([(77, None), (78, [])], shifted.schema))
    for skip in ((), tuple(model.special)):
        texts = en.decode(shifted, model.vocab, model.style, skip=skip)
        tokens = en.ids_to_tokens(shifted, model.vocab, skip=skip)
        joined = tokens.select("doc_id", en.joined_text(F.col("tokens"), model.style))
        assert {r[0]: r[1] for r in texts.collect()} == {r[0]: r[1] for r in joined.collect()}
        assert "ArrowEvalPython" not in texts._jdf.queryExecution().toString()


def test_wordpiece_guesses_stay_as_many_as_hold(corpus, monkeypatch):
    """After a pass whose guesses failed their number grew again to the one that fails."""
    tried, passes = mt.MergeTrainer.tried, []

    def few_hold(self, guesses, near, symbols):
        accepted = tried(self, guesses[: 1 if len(guesses) > 4 else None], near, symbols)
        passes.append((len(guesses), len(accepted)))
        return accepted

    monkeypatch.setattr(mt.MergeTrainer, "tried", few_hold)
    for name, value in (("FEWEST_GUESSES", 2), ("MOST_GUESSES", 8)):
        monkeypatch.setattr(mt, name, value)
    args = ct.stripped_word_counts(corpus), tx.wordpiece_characters, 20, WORDPIECE_SPECIAL_TOKENS, tx.WORDPIECE_PREFIX, True
    merges = mt.first_merges(*args).collect()
    assert len(merges) == 20 and [n for n, _ in passes].count(8) == 1
    monkeypatch.undo()
    assert mt.first_merges(*args).collect() == merges
