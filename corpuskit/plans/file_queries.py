"""Writing to and reading from files in the shared folder."""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import functions as F

from corpuskit.functions import vectors as vc
from corpuskit.operators import vocab as vb
from corpuskit.operators import windows as wn
from corpuskit.operators.tokenizers import Tokenizer
from corpuskit.plans.catalog import documents, embeddings, query, rounded, table
from corpuskit.plans.encode_queries import vocab_and_docs
from corpuskit.plans.training_queries import trained
from corpuskit.plans.vocab_queries import CHAR_VOCAB
from corpuskit.session import checkpoint_dir
from corpuskit.sources import corpus, models


def fresh_path(spark, name):
    return f"{checkpoint_dir(spark)}/{name}-{uuid4().hex}"


@query("text_lines", """
select line, count(*) as n from (select unnest(string_split(text, chr(10))) as line from documents) group by line""")
def text_lines(spark, sf):
    """Documents written as text files and read back line by line."""
    path = fresh_path(spark, "text")
    documents(spark, sf).select("text").write.text(path)
    lines = corpus.read_lines(spark, path)
    return lines.groupBy(F.col("text").alias("line")).agg(F.count("*").alias("n"))


@query("text_files", "select cast(count(*) as bigint) as n_turns, cast(sum(length(text)) as bigint) as n_chars from conversations")
def text_files(spark, sf):
    """Conversations written as a few text files, each read as one document."""
    path = fresh_path(spark, "texts")
    turns = table(spark, sf, "conversations", "text")
    turns.write.option("lineSep", "\x00").text(path)
    docs = corpus.read_text(spark, path)
    ended = F.size(F.split("text", "\x00")) - 1
    return docs.agg(
        F.sum(ended).cast("bigint").alias("n_turns"), F.sum(F.length("text") - ended).alias("n_chars")
    )


@query("saved_embeddings", """
select vec_id as id, 'v' || vec_id as token, round(list_sum(cast(embedding as double[])), 6) + 0.0 as total from embeddings""")
def saved_embeddings(spark, sf):
    path = fresh_path(spark, "vectors")
    e = embeddings(spark, sf)
    names = e.select("id", F.concat(F.lit("v"), F.col("id").cast("string")).alias("token"))
    models.write_embeddings(e.select("id", "vec"), names, path)
    back = models.read_embeddings(spark, path)
    return back.select("id", "token", rounded(vc.total(vc.as_double(F.col("vec")))).alias("total"))


@query("saved_tokenizer_tables", CHAR_VOCAB)
def saved_tokenizer_tables(spark, sf):
    """A character vocabulary saved as tables and loaded again."""
    path = fresh_path(spark, "tokenizer")
    char_level = vb.char_vocab(documents(spark, sf))
    no_merges = spark.createDataFrame([], "rank int, left string, right string, merged string")
    models.write_tables(Tokenizer("bpe", 0, char_level, no_merges), path)
    return models.read_tables(spark, path).vocab


@query("saved_tokenizer_json")
def saved_tokenizer_json(spark, sf):
    """The merges of a trained model after a trip through the JSON file."""
    path = fresh_path(spark, "json")
    models.write_json(trained(spark, sf, "sentencepiece_bpe"), path)
    return models.read_json(spark, path).merges


@query("pair_batches")
def pair_batches(spark, sf):
    """Training pairs dealt to batches; the batch sizes."""
    vocab, docs = vocab_and_docs(spark, sf)
    pairs = wn.skipgram_pairs(wn.known_word_ids(docs, vocab))
    dealt = corpus.hashed_batches(pairs, 64, "doc_id", "pos", "slot", seed=5)
    return dealt.groupBy("batch_id").agg(F.count("*").alias("n"))
