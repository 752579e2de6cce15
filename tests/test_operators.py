import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from corpuskit.functions import arrays, subwords
from corpuskit.operators import counts as ct
from corpuskit.operators import embedding_training as et
from corpuskit.operators import encode as en
from corpuskit.operators import lookup
from corpuskit.operators import lowrank as lr
from corpuskit.operators import similarity as sm
from corpuskit.operators import tokenizers as tk
from corpuskit.operators import vocab as vb
from corpuskit.operators.numbering import dense_ids
from corpuskit.operators import windows as wn
from corpuskit.functions import rewards as rw, text as tx
from corpuskit.sources import corpus as cp
from corpuskit.sources import models
from corpuskit.streaming import rows as sr


def vector_table(spark, m):
    return spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(m)], "id bigint, vec array<double>")


@pytest.fixture(scope="module")
def matrix():
    return np.random.default_rng(5).normal(size=(150, 6))


def test_windows_by_hand(spark):
    docs = spark.createDataFrame([(0, "a b c d e"), (1, "a b")], "doc_id bigint, text string")
    vocab = vb.word_vocab(docs)
    ids = wn.known_word_ids(docs, vocab)
    names = {r["id"]: r["token"] for r in vocab.collect()}
    (row,) = wn.cbow_pairs(ids).collect()
    assert (row["pos"], names[row["target"]], [names[c] for c in row["context"]]) == (2, "c", ["a", "b", "d", "e"])
    assert [names[r["context"]] for r in wn.skipgram_pairs(ids).orderBy("slot").collect()] == ["a", "b", "d", "e"]


def test_windows_keep_unknown_and_null_neighbours(spark, monkeypatch):
    monkeypatch.setattr(wn, "WINDOW_ROWS", 2)
    ids = spark.createDataFrame([(7, [5, -1, 3, 4, None, 6, 8]), (None, [1, 2, 3, 4, 5]), (8, [1, 2]), (9, None)], "doc_id bigint, input_ids array<int>")
    got = [(r["doc_id"], r["pos"], r["target"], r["context"]) for r in wn.cbow_pairs(ids).collect()]
    want = [(7, 2, 3, [5, 0, 4, None]), (7, 3, 4, [0, 3, None, 6]), (None, 2, 3, [1, 2, 4, 5])]
    assert sorted(got, key=str) == sorted(want, key=str)


def test_words_by_splitting_equal_words_by_matching(spark):
    texts = ["", " ", "a", " a b ", "\u3000x\u00a0y\x85z\x1cw\u200b v", "\n\n", "q\U0001F600 \u2028r", None]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select(
        tx.words(F.col("t")).alias("split"), F.regexp_extract_all("t", F.lit(tx.WORD_PATTERN), F.lit(0)).alias("matched")
    )
    assert all(r["split"] == r["matched"] for r in rows.collect())


def test_conditions_do_not_repeat_the_lookup(spark, corpus):
    ids = wn.known_word_ids(corpus, vb.word_vocab(corpus)).where(F.size("input_ids") > 0)
    plan = ids._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1


def test_letter_words(spark):
    row = spark.createDataFrame([("The dog. ran",)], "t string").select(tx.letter_words(F.col("t")).alias("w")).first()
    assert row["w"] == ["the", "ran"]


def test_encode_by_hand(spark):
    row = spark.createDataFrame([([9, 8, 7],)], "ids array<int>").select(
        arrays.finish_ids(F.col("ids"), 4, True, 2, 3).alias("cut"),
        arrays.finish_ids(F.col("ids"), 7, True, 2, 3).alias("padded"),
    ).first()
    assert row["cut"] == [2, 9, 8, 7] and row["padded"] == [2, 9, 8, 7, 3, 0, 0]


def test_batches_by_hand(spark):
    rows = spark.createDataFrame([(0, 0, [1, 2, 3]), (0, 1, [1, 2, 3, 4, 5, 6]), (1, 2, [7])], "batch_id int, doc_id int, input_ids array<int>")
    got = {r["doc_id"]: (r["input_ids"], r["attention_mask"]) for r in en.pad_batches(rows, max_length=5).collect()}
    assert got == {0: ([1, 2, 3, 0, 0], [1, 1, 1, 0, 0]), 1: ([1, 2, 3, 4, 5], [1] * 5), 2: ([7], [1])}


def test_large_vocabulary_path_gives_the_same_ids(corpus):
    vocab = vb.word_level_vocab(corpus)
    words = tx.words(F.col("text"))
    small = {r[0]: r[1] for r in en.encode_tokens(corpus, words, vocab).collect()}
    joined = en.encode_tokens(corpus, words, vocab, limit=3)
    assert {r[0]: r[1] for r in joined.collect()} == small
    text = {r[0]: r[1] for r in en.decode(joined, vocab, limit=3).collect()}
    assert text == {r[0]: r[1] for r in en.decode(joined, vocab).collect()}


def test_large_vocabulary_keeps_rows_with_the_same_id_and_null_texts(spark, monkeypatch):
    monkeypatch.setattr(en, "BLOCK_ITEMS", 4)
    docs = spark.createDataFrame([(1, "a b a"), (1, "c d"), (2, None), (None, "b x"), (3, ""), (4, "a " * 9)], "doc_id bigint, text string")
    vocab = spark.createDataFrame([(t, i, False) for i, t in enumerate("<UNK> a b c d".split(), 1)], "token string, id int, is_special boolean")
    ids = en.encode_tokens(docs, tx.words(F.col("text")), vocab, limit=3)
    assert sorted(map(str, ((r[0], r[1]) for r in ids.collect()))) == sorted(map(str, [(1, [2, 3, 2]), (1, [4, 5]), (2, []), (None, [3, 1]), (3, []), (4, [2] * 9)]))
    moved = ids.withColumn("input_ids", F.transform("input_ids", lambda x: x + 1))
    text = en.decode(moved, vocab, unknown="?", skip=(), limit=3)
    assert sorted(map(str, ((r[0], r[1]) for r in text.collect()))) == sorted(map(str, [(1, "bcb"), (1, "d?"), (2, ""), (None, "ca"), (3, ""), (4, "b" * 9)]))


def test_merges_with_bars_come_back_from_json(spark, tmp_path):
    pairs = [("a", "b"), ("|", "|"), ("|", "||"), ("||", "|"), ("~", "|"), ("~1", "|~0"), ("x", "~1"), ("|a", "b|||")]
    merges = spark.createDataFrame([(n, a, b, a + b) for n, (a, b) in enumerate(pairs)], "rank int, left string, right string, merged string")
    vocab = spark.createDataFrame([("|", 4, False)], "token string, id int, is_special boolean")
    models.write_json(tk.Tokenizer("sentencepiece-bpe", 0, vocab, merges), str(tmp_path / "bars"))
    back = models.read_json(spark, str(tmp_path / "bars")).merges
    assert [(r["left"], r["right"], r["merged"]) for r in back.orderBy("rank").collect()] == [(a, b, a + b) for a, b in pairs]


def test_salted_join_with_a_hot_key(spark):
    rows = spark.range(3000).select("id", F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 50)).alias("key"))
    table = rows.select("key").distinct().where("key <> 'k7'").withColumn("value", F.length("key"))
    plain = rows.join(table, "key", "left").select("id", "key", "value")
    salted = lookup.salted_join(rows, table, "key").select("id", "key", "value")
    assert sorted(map(tuple, salted.collect()), key=str) == sorted(map(tuple, plain.collect()), key=str)


def test_dense_ids_do_not_depend_on_partitions(spark):
    words = spark.range(500).select(F.md5(F.col("id").cast("string")).alias("token"))
    expected = {w: i for i, w in enumerate(sorted(r[0] for r in words.collect()))}
    for n in (1, 7):
        got = {r["token"]: r["id"] for r in dense_ids(words.repartition(n), "token").collect()}
        assert got == expected


def test_counts_do_not_depend_on_partitions(corpus):
    one = sorted(map(tuple, ct.chunk_counts(corpus.coalesce(1)).collect()))
    assert sorted(map(tuple, ct.chunk_counts(corpus.repartition(5)).collect())) == one


def test_batches_are_exact_and_repeatable(spark):
    rows = spark.range(50)
    a = cp.exact_batches(rows, 8, "id", seed=1)
    b = cp.exact_batches(rows.repartition(3), 8, "id", seed=1)
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))
    assert sorted(r["count"] for r in a.groupBy("batch_id").count().collect()) == [2] + [8] * 6


def test_negative_samples_follow_the_weights(spark):
    pairs = spark.range(4000).select(F.col("id").alias("doc_id"), F.lit(0).alias("pos"), F.lit(0).alias("slot"), F.lit(5).alias("target"), F.lit(0).alias("context"))
    weights = spark.createDataFrame([(0, 0.5), (1, 0.3), (2, 0.2)], "id int, weight double")
    drawn = wn.with_negatives(pairs, weights, k=5, seed=3)
    share = {r["id"]: r["n"] / 20000 for r in drawn.select(F.explode("negatives").alias("id")).groupBy("id").agg(F.count("*").alias("n")).collect()}
    assert set(share) == {1, 2} and share[1] == pytest.approx(0.6, abs=0.02)
    again = wn.with_negatives(pairs.repartition(3), weights, k=5, seed=3)
    assert again.exceptAll(drawn).count() == 0


@pytest.mark.parametrize("n, seed", [(2, 1), (50, 2), (3000, 3), (70_000, 4)])
def test_draws_start_close_to_their_place(monkeypatch, n, seed):
    """Each draw was searched by halves among all weights; now few are, and all land where they did."""
    rng = np.random.default_rng(seed)
    weight = rng.pareto(1.0, n) + 1e-3
    weight[1 : n // 3] = 0
    ids, cumulative = np.arange(n) * 3, np.cumsum(weight)
    seeds, positive = rng.integers(-(2**63), 2**63 - 1, 40_000), rng.integers(0, 3 * n, 40_000)
    table = wn.WeightedIds(ids, cumulative)
    searched = []
    monkeypatch.setattr(wn, "np", Counting(np, searched))
    drawn = wn.draw_negatives(seeds, positive, table, 3)
    assert drawn.shape == (40_000, 3) and not (drawn == positive[:, None]).any()
    for slot in range(3):
        want, attempt, todo = np.full(40_000, -1), 0, np.arange(40_000)
        while len(todo):
            u = wn.uniform(seeds[todo], attempt * 3 + slot) * cumulative[-1]
            want[todo] = ids[np.minimum(np.searchsorted(cumulative, u, side="right"), n - 1)]
            todo, attempt = todo[want[todo] == positive[todo]], attempt + 1
        assert drawn[:, slot].tolist() == want.tolist()
    assert sum(searched) < drawn.size / 20


class Counting:
    """numpy that notes how many values are searched by halves."""

    def __init__(self, module, noted):
        self.module, self.noted = module, noted

    def __getattr__(self, name):
        return self.searchsorted if name == "searchsorted" else getattr(self.module, name)

    def searchsorted(self, table, values, **options):
        self.noted.append(np.size(values))
        return self.module.searchsorted(table, values, **options)


def every_pair(table):
    ids = table.select(F.col("id").alias("i"))
    return ids.join(ids.select(F.col("i").alias("j")), F.col("i") < F.col("j"))


def test_closed_forms_against_numpy(spark, matrix):
    matrix = np.vstack([matrix, np.zeros(matrix.shape[1])])
    unit = matrix / np.maximum(np.linalg.norm(matrix, axis=1, keepdims=True), 1e-12)
    sims = unit @ unit.T
    upper = sims[np.triu_indices(151, 1)]
    table = vector_table(spark, matrix)
    assert tuple(sm.cosine_moments(table).first()) == pytest.approx((len(upper), upper.mean(), upper.std(ddof=1)))
    means = {r["id"]: r["mean"] for r in sm.cosine_means(table).collect()}
    want = (sims.sum(axis=1) - np.diag(sims)) / 150
    assert [means[i] for i in range(151)] == pytest.approx(want.tolist())
    one = table.where("id = 0")
    assert tuple(sm.cosine_moments(one).first()) == (0, None, None)
    assert sm.cosine_means(one).first()["mean"] is None


def test_given_pairs_against_numpy(spark, matrix):
    unit = matrix / np.linalg.norm(matrix, axis=1, keepdims=True)
    sims = (unit @ unit.T)[np.triu_indices(150, 1)]
    table = vector_table(spark, matrix)
    values = sm.pair_values(table, every_pair(table))
    expected = (len(sims), sims.mean(), sims.std(ddof=1), sims.min(), sims.max(), np.sort(sims)[(len(sims) - 1) // 2])
    assert tuple(sm.distribution(values).first()) == pytest.approx(expected)
    assert sum(r["n"] for r in sm.histogram(values, 20).collect()) == len(sims)


def test_single_pair(spark):
    table = vector_table(spark, [[0.0], [0.0]])
    values = sm.pair_values(table, every_pair(table), "euclidean")
    got = sm.distribution(values).first()
    assert got["n"] == 1 and got["median"] == 0.0 and got["std"] is None
    assert [tuple(r) for r in sm.histogram(values).collect()] == [(0, 1)]
    nothing = sm.distribution(values.where("false")).first()
    assert nothing["n"] == 0 and nothing["median"] is None
    assert sm.histogram(values.where("false")).count() == 0


def test_nearest_in_several_blocks(spark, matrix):
    table = vector_table(spark, matrix)
    queries = table.select(F.col("id").alias("query_id"), "vec", F.array("id").alias("exclude"))
    one = sorted(map(tuple, sm.nearest_to_each(queries, table, 3).collect()))
    several = sorted(map(tuple, sm.nearest_to_each(queries, table, 3, query_rows=40, table_rows=20).collect()))
    assert [r[:2] + r[3:] for r in several] == [r[:2] + r[3:] for r in one]
    unit = matrix / np.linalg.norm(matrix, axis=1, keepdims=True)
    sims = unit @ unit.T - 2 * np.eye(150)
    best = {(q, p): i for q, i, _, p in one}
    assert all(best[q, 1] == sims[q].argmax() for q in range(150))


def test_unknown_words_give_nothing(spark, matrix):
    table = vector_table(spark, matrix).withColumn("token", F.concat(F.lit("v"), "id"))
    assert sm.similar_words(table, ["nope"]).count() == 0
    assert sm.word_analogy(table, "v1", "nope", "v2").count() == 0
    tokens = [r["token"] for r in sm.word_analogy(table, "v1", "v2", "v3").collect()]
    assert len(tokens) == 5 and not set(tokens) & {"v1", "v2", "v3"}


def test_low_rank_against_numpy(spark, matrix):
    table = vector_table(spark, matrix)
    factors = lr.truncated_svd(table, 3)
    u, s, vt = np.linalg.svd(matrix, full_matrices=False)
    assert factors.sigma == pytest.approx(s[:3])
    got = np.array([r["u"] for r in factors.u.orderBy("id").collect()])
    assert np.abs(got) == pytest.approx(np.abs(u[:, :3]))
    mixing = np.arange(9.0).reshape(3, 3) / 10
    moved = np.array([r["vec"] for r in lr.low_rank_update(table, factors, mixing, 0.5).orderBy("id").collect()])
    assert moved == pytest.approx(matrix + 0.5 * got @ np.diag(factors.sigma) @ mixing @ factors.vt)


def test_training_lowers_the_loss(spark):
    text = "the king rules the land and the queen rules the sea " * 30
    docs = spark.createDataFrame([(i, text) for i in range(4)], "doc_id bigint, text string")
    vocab = vb.word_vocab(docs)
    ids = wn.known_word_ids(docs, vocab)
    pairs = wn.skipgram_pairs(ids)
    size = vocab.count()
    runs = [
        et.train_cbow(wn.cbow_pairs(ids), size, dim=8, epochs=4),
        et.train_skipgram(pairs, size, dim=8, epochs=4),
        et.train_skipgram_negative(wn.with_negatives(pairs, vb.negative_weights(vocab), 3), size, dim=8, epochs=4),
    ]
    for run in runs:
        losses = [r["loss"] for r in run.losses.orderBy("epoch").collect()]
        assert len(losses) == 4 and losses[-1] < losses[0]
        assert run.embeddings.count() == size


def test_models_survive_files(spark, corpus, tmp_path):
    for model in (tk.train_bpe(corpus, 70), tk.train_unigram(corpus, 60), tk.train_sentencepiece(corpus, 70)):
        expected = sorted((r[0], tuple(r[1])) for r in model.encode(corpus).collect())
        models.write_tables(model, str(tmp_path / model.kind))
        models.write_json(model, str(tmp_path / f"{model.kind}.json"))
        for copy in (
            models.read_tables(spark, str(tmp_path / model.kind)),
            models.read_json(spark, str(tmp_path / f"{model.kind}.json")),
        ):
            assert copy.kind == model.kind
            assert sorted((r[0], tuple(r[1])) for r in copy.encode(corpus).collect()) == expected


def test_text_files(spark, tmp_path):
    for name, text in (("b", "two\nlines"), ("a", "one")):
        (tmp_path / f"{name}.txt").write_text(text)
    got = cp.read_text(spark, str(tmp_path)).orderBy("doc_id").collect()
    assert [r["text"] for r in got] == ["one", "two\nlines"]
    got = cp.read_lines(spark, str(tmp_path)).orderBy("doc_id").collect()
    assert [r["text"] for r in got] == ["one", "two", "lines"]


def test_embeddings_survive_files(spark, matrix, tmp_path):
    table = vector_table(spark, matrix)
    vocab = table.select("id", F.concat(F.lit("v"), "id").alias("token"))
    models.write_embeddings(table, vocab, str(tmp_path / "e"))
    back = models.read_embeddings(spark, str(tmp_path / "e"))
    assert back.columns == ["id", "token", "vec"] and back.count() == 150


def test_streams_give_the_batch_result(spark, corpus, tmp_path):
    source = str(tmp_path / "in")
    corpus.repartition(3).write.parquet(source)
    model = tk.train_bpe(corpus, 60)
    stream = sr.read_stream(spark, source, "doc_id bigint, text string")
    sr.write_available(sr.encode_stream(stream, model), str(tmp_path / "ids"), str(tmp_path / "c1")).awaitTermination()
    got = sorted((r[0], tuple(r[1])) for r in spark.read.parquet(str(tmp_path / "ids")).collect())
    assert got == sorted((r[0], tuple(r[1])) for r in model.encode(corpus).collect())
    turns = stream.select(F.lit(0).alias("prompt_id"), F.col("doc_id").alias("sample_id"), F.lit("p").alias("prompt"), F.col("text").alias("response"))
    scored = sr.score_stream(turns, rw.pattern_reward, 0.2)
    sr.write_available(scored, str(tmp_path / "scored"), str(tmp_path / "c2")).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "scored")).count() == corpus.count()
    sr.reprompt_batches(scored, str(tmp_path / "new"), str(tmp_path / "c3")).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "new")).count() == corpus.count()


def test_plans_have_no_cartesian_product_and_prune_columns(spark):
    import __spark_entry__ as catalog
    from conftest import SMALL

    for name in ("chunk_counts", "word_encoded", "cbow_pairs", "group_advantages", "similarity_by_vector"):
        plan = catalog.queries()[name](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    plan = catalog.queries()["chunk_counts"](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<doc_id:bigint,text:string>" in plan
    assert "SortAggregate" not in plan


def test_text_index_compares_texts_with_equal_codes(monkeypatch):
    texts = pa.array(["a", "", "bé", "a", "zz", None, "long" * 50])
    asked = pa.array(["none", "a", "", "bé", "zz", "aaa", "long" * 50, None]).slice(1)
    for codes in (subwords.text_codes, lambda x: np.zeros(len(x), np.uint64)):
        monkeypatch.setattr(subwords, "text_codes", codes)
        index = subwords.TextIndex(texts, np.arange(7, dtype=np.int32))
        assert index.find(asked, -1).tolist() == [3, 1, 2, 4, -1, 6, -1]  # of equal texts the last one
    assert subwords.TextIndex(texts[:0], np.zeros(0, np.int32)).find(asked, 9).tolist() == [9] * 7


def test_vocabularies_beyond_a_million_words_leave_documents_in_place(spark):
    """More words than are broadcast to joins, few bytes: no list is shuffled or written."""
    size = 1_000_100
    vocab = spark.range(size).select(F.concat(F.lit("w"), "id").alias("token"), F.col("id").cast("int").alias("id"))
    docs = spark.createDataFrame([(0, "w0 w1000099 x w7"), (1, None), (2, "")], "doc_id bigint, text string")
    ids = en.encode_tokens(docs, tx.words(F.col("text")), vocab, unk_id=-1)
    text = en.decode(ids.withColumn("input_ids", F.concat("input_ids", F.array(F.lit(None).cast("int"), F.lit(size)))), vocab, unknown="?")
    for plan in (ids, text):
        assert "Exchange" not in plan._jdf.queryExecution().executedPlan().toString()
    assert {r[0]: r[1] for r in ids.collect()} == {0: [0, 1000099, -1, 7], 1: [], 2: []}
    assert {r[0]: r[1] for r in text.collect()}[0] == "w0w1000099?w7??"
