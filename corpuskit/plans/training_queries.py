"""Training tokenizers and word vectors, and applying what was trained.

These have no SQL counterpart; the tests check them against brute force.
"""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import functions as F

from corpuskit.operators import counts as ct
from corpuskit.operators import embedding_training as et
from corpuskit.operators import tokenizers as tk
from corpuskit.operators import unigram as ug
from corpuskit.operators import vocab as vb
from corpuskit.operators import windows as wn
from corpuskit.plans.catalog import WORDS, digest, documents, query, rounded

BPE_SIZE, PIECE_SIZE, UNIGRAM_SIZE = 1000, 1000, 1000
TRAINERS = {
    "bpe": lambda docs: tk.train_bpe(docs, BPE_SIZE),
    "wordpiece": lambda docs: tk.train_wordpiece(docs, PIECE_SIZE),
    "unigram": lambda docs: tk.train_unigram(docs, UNIGRAM_SIZE),
    "sentencepiece_bpe": lambda docs: tk.train_sentencepiece(docs, BPE_SIZE, "bpe"),
    "sentencepiece_unigram": lambda docs: tk.train_sentencepiece(docs, UNIGRAM_SIZE, "unigram"),
}


@lru_cache(maxsize=16)
def trained(spark, sf: str, name: str) -> tk.Tokenizer:
    """The models are shared by the queries of a session."""
    return TRAINERS[name](documents(spark, sf))


def vocab_query(name):
    def run(spark, sf):
        return trained(spark, sf, name).vocab

    return run


def encode_query(name):
    def run(spark, sf):
        encoded = trained(spark, sf, name).encode(documents(spark, sf))
        ids = F.col("input_ids")
        return encoded.select(
            "doc_id", F.size(ids).alias("n"),
            F.size(F.filter(ids, lambda x: x == 1)).alias("n_unknown"), digest(ids).alias("ids"),
        )

    return run


def decode_query(name):
    def run(spark, sf):
        model = trained(spark, sf, name)
        return model.decode(model.encode(documents(spark, sf))).select("doc_id", F.md5("text").alias("text"))

    return run


# Byte-pair keeps white space, so decoding gives the very text back; with marked
# spaces words come back joined by single blanks.
ROUND_TRIPS = {
    "bpe": "select doc_id, md5(text) as text from documents",
    "sentencepiece_bpe": f"select doc_id, md5(array_to_string({WORDS}, ' ')) as text from documents",
}

for _name in TRAINERS:
    query(f"{_name}_training")(vocab_query(_name))
    query(f"{_name}_encoded")(encode_query(_name))
    query(f"{_name}_decoded", ROUND_TRIPS.get(_name))(decode_query(_name))


@query("bpe_merges")
def bpe_merges(spark, sf):
    return trained(spark, sf, "bpe").merges


@query("bpe_padded_batches")
def bpe_padded_batches(spark, sf):
    docs = documents(spark, sf).withColumn("batch_id", F.floor(F.col("doc_id") / 32))
    out = trained(spark, sf, "bpe").encode_batches(docs, max_length=256, add_special=True)
    return out.select(
        "batch_id", "doc_id", F.size("input_ids").alias("n"),
        F.aggregate("attention_mask", F.lit(0), lambda a, x: a + x).alias("n_real"),
    )


def unigram_model(spark, sf):
    types = ct.stripped_word_counts(documents(spark, sf))
    return types, ug.model_dict(trained(spark, sf, "unigram").unigram)


@query("unigram_corpus_loss")
def unigram_corpus_loss(spark, sf):
    return ug.corpus_loss(*unigram_model(spark, sf)).select(F.round("loss", 3).alias("loss"))


@query("unigram_token_importance")
def unigram_token_importance(spark, sf):
    return ug.token_importance(*unigram_model(spark, sf)).select(
        "token", F.round("importance", 3).alias("importance")
    )


@query("pruned_unigram_vocab")
def pruned_unigram_vocab(spark, sf):
    types = ct.stripped_word_counts(documents(spark, sf))
    seeds = ct.seed_subwords(types, 600)
    return ug.prune(types, seeds, 500, ratio=0.1).select("token", rounded(F.col("logp")).alias("logp"))


WORD_MIN_FREQ = 2


def training_pairs(spark, sf):
    docs = documents(spark, sf)
    vocab = vb.word_vocab(docs, min_freq=WORD_MIN_FREQ).persist()
    ids = wn.known_word_ids(docs, vocab)
    return vocab, vocab.count(), ids


@query("skipgram_negative_vectors")
def skipgram_negative_vectors(spark, sf):
    vocab, size, ids = training_pairs(spark, sf)
    pairs = wn.with_negatives(wn.skipgram_pairs(ids), vb.negative_weights(vocab), k=5, seed=1)
    trained_vectors = et.train_skipgram_negative(pairs, size, dim=16, epochs=2)
    return vocab.select("id", "token").join(trained_vectors.embeddings, "id")


@query("cbow_losses")
def cbow_losses(spark, sf):
    _, size, ids = training_pairs(spark, sf)
    return et.train_cbow(wn.cbow_pairs(ids), size, dim=16, epochs=2).losses


@query("skipgram_losses")
def skipgram_losses(spark, sf):
    _, size, ids = training_pairs(spark, sf)
    return et.train_skipgram(wn.skipgram_pairs(ids), size, dim=16, epochs=1).losses
