"""Splitting, marking, cutting and filling texts."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpuskit.functions import arrays, text as tx
from corpuskit.operators import encode as en
from corpuskit.operators import vocab as vb
from corpuskit.plans.catalog import (
    CHUNKS, LETTER_WORDS, WORDS, digest, digest_sql, documents, query, stripped, table,
    token_rows_sql,
)
from corpuskit.sources import corpus


@query("corpus_overview", "select lang, count(*) as n_docs, cast(sum(length(text)) as bigint) as n_chars from documents group by lang")
def corpus_overview(spark, sf):
    docs = corpus.read_documents(spark, f"{sf}/documents.parquet", "lang", "text")
    return docs.groupBy("lang").agg(F.count("*").alias("n_docs"), F.sum(F.length("text")).alias("n_chars"))


@query("corpus_repeated", """
select lang, copy, count(*) as n_docs from documents, (select unnest([0, 1, 2]) as copy) group by lang, copy""")
def corpus_repeated(spark, sf):
    docs = corpus.repeat(documents(spark, sf, "lang"), 3)
    return docs.groupBy("lang", "copy").agg(F.count("*").alias("n_docs"))


@query("shuffled_batches")
def shuffled_batches(spark, sf):
    prompts = table(spark, sf, "conversations").where("role = 'user'").select("conv_id", "turn", F.col("text").alias("prompt"))
    return corpus.exact_batches(prompts, 16, "conv_id", "turn", seed=7)


@query("hashed_batches")
def hashed_batches(spark, sf):
    prompts = table(spark, sf, "conversations").where("role = 'user'").select("conv_id", "turn", F.col("text").alias("prompt"))
    return corpus.shuffled(corpus.hashed_batches(prompts, 8, "conv_id", "turn", seed=7), "conv_id", "turn", seed=7)


@query("chunk_split", f"select doc_id, cast(len({CHUNKS}) as integer) as n, {digest_sql(CHUNKS)} as parts from documents")
def chunk_split(spark, sf):
    parts = tx.chunks(F.col("text"))
    return documents(spark, sf).select("doc_id", F.size(parts).alias("n"), digest(parts).alias("parts"))


@query("word_split", f"select doc_id, cast(len({WORDS}) as integer) as n, {digest_sql(WORDS)} as parts from documents")
def word_split(spark, sf):
    parts = tx.words(F.col("text"))
    return documents(spark, sf).select("doc_id", F.size(parts).alias("n"), digest(parts).alias("parts"))


@query("stripped_text", f"select doc_id, cast(length({stripped('text')}) as integer) as n, md5({stripped('text')}) as stripped from documents")
def stripped_text(spark, sf):
    bare = tx.strip(F.col("text"))
    return documents(spark, sf).select("doc_id", F.length(bare).alias("n"), F.md5(bare).alias("stripped"))


@query("letter_words", f"select doc_id, cast(len({LETTER_WORDS}) as integer) as n, {digest_sql(LETTER_WORDS)} as parts from documents")
def letter_words(spark, sf):
    parts = tx.letter_words(F.col("text"))
    return documents(spark, sf).select("doc_id", F.size(parts).alias("n"), digest(parts).alias("parts"))


@query("characters", f"select doc_id, cast(length(text) as integer) as n, {digest_sql("string_split(text, '')")} as parts from documents")
def characters(spark, sf):
    parts = tx.characters(F.col("text"))
    return documents(spark, sf).select("doc_id", F.size(parts).alias("n"), digest(parts).alias("parts"))


@query("wordpiece_characters", f"""
select word, array_to_string(list_transform(string_split(word, ''),
         lambda c, i: case when i = 1 then c else '##' || c end), ' ') as pieces
from (select distinct unnest({WORDS}) as word from conversations)""")
def wordpiece_characters(spark, sf):
    words = table(spark, sf, "conversations", "text").select(F.explode(tx.words(F.col("text"))).alias("word")).distinct()
    return words.select("word", F.array_join(tx.wordpiece_characters(F.col("word")), " ").alias("pieces"))


@query("word_substrings", f"""
with w as (select unnest({WORDS}) as word from conversations),
s as (select word, unnest(range(1, length(word) + 1)) as i from w),
t as (select word, i, unnest(range(1, least(16, length(word) - i + 1) + 1)) as n from s)
select substring(word, i, n) as token, count(*) as freq from t group by 1""")
def word_substrings(spark, sf):
    words = table(spark, sf, "conversations", "text").select(F.explode(tx.words(F.col("text"))).alias("word"))
    # Word types first: each word is cut up once, however often it occurs.
    types = words.groupBy("word").agg(F.count("*").alias("n"))
    rows = types.select("n", F.explode(tx.substrings(F.col("word"))).alias("token"))
    return rows.groupBy("token").agg(F.sum("n").alias("freq"))


MARKED = f"(case when replace(text, ' ', '{tx.SPACE_MARK}') like '{tx.SPACE_MARK}%' then replace(text, ' ', '{tx.SPACE_MARK}') else '{tx.SPACE_MARK}' || replace(text, ' ', '{tx.SPACE_MARK}') end)"


@query("marked_spaces", f"select doc_id, cast(length({MARKED}) as integer) as n, md5({MARKED}) as marked from documents")
def marked_spaces(spark, sf):
    marked = tx.mark_spaces(F.col("text"))
    return documents(spark, sf).select("doc_id", F.length(marked).alias("n"), F.md5(marked).alias("marked"))


@query("unmarked_spaces", f"select doc_id, md5({stripped(f"replace({MARKED}, '{tx.SPACE_MARK}', ' ')")}) as plain from documents")
def unmarked_spaces(spark, sf):
    return documents(spark, sf).select("doc_id", F.md5(tx.unmark_spaces(tx.mark_spaces(F.col("text")))).alias("plain"))


# Conversations carry no reasoning tags, so the query wraps every text in some.
TAGGED = "'<think>' || text || '</think> ' || text || '<reasoning>a' || chr(10) || 'b</reasoning><thinking></thinking>'"
UNTAGGED = f"({TAGGED})"
for _p in tx.THINKING_PATTERNS:
    UNTAGGED = f"regexp_replace({UNTAGGED}, '{_p}', '', 'g')"


@query("thinking_removed", f"select conv_id, turn, md5({stripped(UNTAGGED)}) as answer from conversations")
def thinking_removed(spark, sf):
    tagged = F.concat(
        F.lit("<think>"), "text", F.lit("</think> "), "text",
        F.lit("<reasoning>a\nb</reasoning><thinking></thinking>"),
    )
    return table(spark, sf, "conversations").select("conv_id", "turn", F.md5(tx.remove_thinking(tagged)).alias("answer"))


@query("filled_template", """
select conv_id, turn, md5('[' || role || '] ' || text || chr(10) || '{role}' || role) as filled from conversations""")
def filled_template(spark, sf):
    filled = tx.fill_template("[{role}] {text}\n{mark}{role}", role=F.col("role"), text=F.col("text"), mark=F.lit("{role}"))
    return table(spark, sf, "conversations").select("conv_id", "turn", F.md5(filled).alias("filled"))


@query("truncated_text", """
select doc_id, md5(substring(text, 1, 200)) as head,
       md5(case when length(text) > 200 then right(text, 200) else text end) as tail from documents""")
def truncated_text(spark, sf):
    text = F.col("text")
    return documents(spark, sf).select(
        "doc_id", F.md5(tx.truncate_chars(text, 200, "right")).alias("head"),
        F.md5(tx.truncate_chars(text, 200, "left")).alias("tail"),
    )


CHAR_IDS = f"""
chars as ({token_rows_sql("string_split(text, '')")}),
vocab as (select token, row_number() over (order by token) + 3 as id from (select distinct token from chars)),
ids as (select doc_id, list(id order by pos) as ids from chars join vocab using (token) group by doc_id)"""


@query("padded_ids", f"""
with {CHAR_IDS}
select doc_id, {digest_sql("list_slice(list_concat(ids, list_transform(range(greatest(500 - len(ids), 0)), lambda x: 0)), 1, 500)")} as fixed,
       {digest_sql("list_concat(ids, list_transform(range(greatest(500 - len(ids), 0)), lambda x: 0))")} as filled,
       {digest_sql("list_slice(list_concat(list_transform(ids, lambda x: case when x = 7 then 0 else 1 end), list_transform(range(greatest(500 - len(ids), 0)), lambda x: 1)), 1, 500)")} as mask
from ids""")
def padded_ids(spark, sf):
    docs = documents(spark, sf)
    encoded = en.encode_tokens(docs, tx.characters(F.col("text")), vb.char_vocab(docs))
    ids = F.col("input_ids")
    return encoded.select(
        "doc_id", digest(arrays.pad_ids(ids, 500)).alias("fixed"),
        digest(arrays.pad_ids(ids, 500, truncate=False)).alias("filled"),
        digest(arrays.mask_from_ids(arrays.pad_ids(ids, 500), pad_id=7)).alias("mask"),
    )
