"""Frequencies, pairs, seeds and vocabularies."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpuskit.functions import text as tx
from corpuskit.operators import counts as ct
from corpuskit.operators import encode as en
from corpuskit.operators import vocab as vb
from corpuskit.operators.tokenizers import Tokenizer
from corpuskit.plans.catalog import (
    CHUNKS, LETTER_WORDS, WORDS, documents, query, rounded, table, token_rows_sql,
)
from corpuskit.sources import models


def counted(tokens: str, word: str = "token") -> str:
    return f"""counts as (
  select {word} as word, count(*) as freq, min(doc_id * 16777216 + pos) as first
  from ({token_rows_sql(tokens)}) group by 1)"""


PLACE = "first // 16777216 as first_doc, first % 16777216 as first_pos"


def placed(df):
    return df.withColumns({"first_doc": ct.first_doc(F.col("first")), "first_pos": ct.first_pos(F.col("first"))}).drop("first")


@query("chunk_counts", f"with {counted(CHUNKS)} select word, freq, {PLACE} from counts")
def chunk_counts(spark, sf):
    return placed(ct.chunk_counts(documents(spark, sf)))


# Ids as far apart as hashes are, negative ones among them.
FAR_IDS = "select (doc_id % 1001 - 500) * 18014398509481984 + doc_id as doc_id, text from documents"


@query("far_chunk_counts", f"""select word, count(*) as freq, min({{'d': doc_id, 'p': pos}}).d as first_doc, min({{'d': doc_id, 'p': pos}}).p as first_pos
  from (select token as word, doc_id, pos from ({token_rows_sql(CHUNKS, f"({FAR_IDS})")})) group by word""")
def far_chunk_counts(spark, sf):
    """Chunk counts over ids from the whole range of a BIGINT."""
    far = (F.col("doc_id") % 1001 - 500) * F.lit(18014398509481984) + F.col("doc_id")
    return placed(ct.chunk_counts(documents(spark, sf).withColumn("doc_id", far)))


@query("stripped_word_counts", f"with {counted(WORDS)} select word, freq, {PLACE} from counts")
def stripped_word_counts(spark, sf):
    return placed(ct.stripped_word_counts(documents(spark, sf)))


SPLIT_WP = "list_transform(string_split(word, ''), lambda c, i: case when i = 1 then c else '##' || c end)"


@query("wordpiece_word_types", f"with {counted(WORDS)} select array_to_string({SPLIT_WP}, ' ') as pieces, freq, {PLACE} from counts")
def wordpiece_word_types(spark, sf):
    types = ct.split_wordpieces(ct.stripped_word_counts(documents(spark, sf)))
    return placed(types.select(F.array_join("tokens", " ").alias("pieces"), "freq", "first"))


@query("marked_word_counts", f"with {counted(WORDS)} select '{tx.SPACE_MARK}' || word as word, freq from counts")
def marked_word_counts(spark, sf):
    return ct.marked_word_counts(documents(spark, sf)).select("word", "freq")


@query("marked_word_types", f"""
with {counted(WORDS)} select array_to_string(string_split('{tx.SPACE_MARK}' || word, ''), ' ') as symbols, freq from counts""")
def marked_word_types(spark, sf):
    types = ct.split_characters(ct.marked_word_counts(documents(spark, sf)))
    return types.select(F.array_join("tokens", " ").alias("symbols"), "freq")


@query("distinct_symbols", "select distinct unnest(string_split(text, '')) as token from documents")
def distinct_symbols(spark, sf):
    return ct.distinct_symbols(ct.split_characters(ct.chunk_counts(documents(spark, sf))))


SPECIALS = "select * from (values ('<PAD>', 0, true), ('<UNK>', 1, true), ('<BOS>', 2, true), ('<EOS>', 3, true)) t(token, id, is_special)"
CHAR_VOCAB = f"""{SPECIALS} union all
select token, cast(row_number() over (order by token) + 3 as integer), false
from (select distinct unnest(string_split(text, '')) as token from documents)"""


@query("symbol_vocab", CHAR_VOCAB)
def symbol_vocab(spark, sf):
    return vb.symbol_vocab(ct.distinct_symbols(ct.split_characters(ct.chunk_counts(documents(spark, sf)))))


@query("inverted_vocab", f"select id, max(token) as token from ({CHAR_VOCAB}) group by id")
def inverted_vocab(spark, sf):
    return vb.invert(vb.char_vocab(documents(spark, sf)))


@query("char_vocab", CHAR_VOCAB)
def char_vocab(spark, sf):
    return vb.char_vocab(documents(spark, sf))


@query("vocab_json", f"select token, id from ({CHAR_VOCAB})")
def vocab_json(spark, sf):
    """Vocabulary written as one JSON object and read back."""
    model = Tokenizer("wordpiece", 300, vb.char_vocab(documents(spark, sf)))
    data = models.to_json(model).select(F.from_json("value", models.JSON_SCHEMA).alias("j"))
    return data.select(F.explode("j.vocab").alias("token", "id"))


WORD_LEVEL_VOCAB = f"""{SPECIALS} union all
select token, cast(row_number() over (order by token) + 3 as integer), false
from (select distinct unnest({WORDS}) as token from documents)"""


@query("word_level_vocab", WORD_LEVEL_VOCAB)
def word_level_vocab(spark, sf):
    return vb.word_level_vocab(documents(spark, sf)).select("token", "id", "is_special")


def word_vocab_sql(min_freq: int) -> str:
    return f"""select '<UNK>' as token, 0 as id, null as freq union all
select token, cast(row_number() over (order by token) as integer), n
from (select token, count(*) as n from ({token_rows_sql(LETTER_WORDS)}) group by token having count(*) >= {min_freq})"""


@query("word_vocab", word_vocab_sql(2))
def word_vocab(spark, sf):
    return vb.word_vocab(documents(spark, sf), min_freq=2).select("token", "id", "freq")


@query("symbol_counts", f"""
with {counted(CHUNKS)} select token, cast(sum(freq) as bigint) as freq
from (select unnest(string_split(word, '')) as token, freq from counts) group by token""")
def symbol_counts(spark, sf):
    return ct.symbol_counts(ct.split_characters(ct.chunk_counts(documents(spark, sf))))


def pairs_sql(tokens: str, split: str) -> str:
    return f"""{counted(tokens)},
types as (select {split} as t, freq, first from counts),
each_pair as (select t[i] as "left", t[i + 1] as "right", freq, first, i - 1 as "at"
  from (select t, freq, first, unnest(range(1, len(t))) as i from types)),
pairs as (select "left", "right", cast(sum(freq) as bigint) as freq, min({{'f': first, 'a': "at"}}) as met
  from each_pair group by 1, 2),
symbols as (select token, cast(sum(freq) as bigint) as freq from (select unnest(t) as token, freq from types) group by 1),
scores as (select p.*, p.freq / (cast(a.freq as double) * cast(b.freq as double)) as score
  from pairs p join symbols a on a.token = p."left" join symbols b on b.token = p."right")"""


CHAR_PAIRS = pairs_sql(CHUNKS, "string_split(word, '')")
PIECE_PAIRS = pairs_sql(WORDS, SPLIT_WP)
MET = 'met.f // 16777216 as first_doc, met.f % 16777216 as first_pos, cast(met.a as integer) as "at"'


@query("pair_counts", f'with {CHAR_PAIRS} select "left", "right", freq, {MET} from pairs')
def pair_counts(spark, sf):
    return placed(ct.pair_counts(ct.split_characters(ct.chunk_counts(documents(spark, sf)))))


@query("pair_scores", f'with {PIECE_PAIRS} select "left", "right", freq, round(score * 1e6, 6) as score from scores')
def pair_scores(spark, sf):
    types = ct.split_wordpieces(ct.stripped_word_counts(documents(spark, sf)))
    return ct.pair_scores(types, with_first=False).select(
        "left", "right", "freq", rounded(F.col("score") * 1e6).alias("score")
    )


@query("top_pairs", f'with {CHAR_PAIRS} select "left", "right", freq, {MET} from pairs order by freq desc, met limit 20')
def top_pairs(spark, sf):
    """The twenty most frequent neighbouring symbols: the first step of byte-pair training."""
    pairs = ct.pair_counts(ct.split_characters(ct.chunk_counts(documents(spark, sf))))
    return placed(ct.best_pairs(pairs, n=20))


@query("best_scored_pair", f'with {PIECE_PAIRS} select "left", "right", freq, round(score * 1e6, 6) as score from scores order by scores.score desc, met limit 1')
def best_scored_pair(spark, sf):
    types = ct.split_wordpieces(ct.stripped_word_counts(documents(spark, sf)))
    return ct.best_pairs(ct.pair_scores(types), "score").select(
        "left", "right", "freq", rounded(F.col("score") * 1e6).alias("score")
    )


SEEDS = f"""{counted(WORDS)},
starts as (select word, freq, first, unnest(range(1, length(word) + 1)) as i from counts),
subs as (select substring(word, i, n) as token, freq, first, i, n
  from (select *, unnest(range(1, least(16, length(word) - i + 1) + 1)) as n from starts)),
tokens as (select token, cast(sum(freq) as bigint) as freq, min({{'f': first, 'i': i, 'n': n}}) as met from subs group by token),
ranked as (select token, freq, ln(freq / (select sum(freq) from subs)) as logp,
  row_number() over (order by freq desc, met) as seed_rank from tokens)"""


@query("seed_subwords", f"with {SEEDS} select token, freq, round(logp, 6) as logp, cast(seed_rank as integer) as seed_rank from ranked where seed_rank <= 2000")
def seed_subwords(spark, sf):
    seeds = ct.seed_subwords(ct.stripped_word_counts(documents(spark, sf)), 2000)
    return seeds.select("token", "freq", rounded(F.col("logp")).alias("logp"), "seed_rank")


@query("top_token_probabilities", f"with {SEEDS} select token, round(exp(logp), 6) as prob from ranked order by seed_rank limit 10")
def top_token_probabilities(spark, sf):
    seeds = ct.seed_subwords(ct.stripped_word_counts(documents(spark, sf)), 2000)
    return vb.top_probabilities(seeds).select("token", rounded(F.col("prob")).alias("prob"))


@query("token_probabilities", f"""
with {SEEDS} select b.token, coalesce(round(exp(logp), 6), 0) as prob
from (select distinct unnest({WORDS}) as token from benchmark) b left join (select * from ranked where seed_rank <= 2000) r using (token)""")
def token_probabilities(spark, sf):
    seeds = ct.seed_subwords(ct.stripped_word_counts(documents(spark, sf)), 2000)
    asked = table(spark, sf, "benchmark", "text").select(F.explode(tx.words(F.col("text"))).alias("token")).distinct()
    return vb.probability_of(asked, seeds).select("token", rounded(F.col("prob")).alias("prob"))


def stats_sql(tokens: str) -> str:
    return f"""select doc_id, length(text) as n_chars, len(l) as n_tokens,
  round(length(text) / nullif(len(l), 0), 6) as chars_per_token,
  len(list_distinct(l)) as n_distinct,
  round(list_sum(list_transform(l, lambda t: length(t))) / nullif(len(l), 0), 6) as mean_token_length
from (select doc_id, text, {tokens} as l from documents)"""


def rounded_stats(stats):
    return stats.withColumns({c: rounded(F.col(c)) for c in ("chars_per_token", "mean_token_length")})


@query("document_token_stats", stats_sql(WORDS))
def document_token_stats(spark, sf):
    return rounded_stats(ct.row_token_stats(documents(spark, sf), tx.words(F.col("text"))))


@query("corpus_token_stats", f"""
with w as (select unnest({WORDS}) as t from documents)
select (select cast(sum(length(text)) as bigint) from documents) as n_chars, count(*) as n_tokens,
  round((select sum(length(text)) from documents) / count(*), 6) as chars_per_token,
  count(distinct t) as n_distinct, round(avg(length(t)), 6) as mean_token_length from w""")
def corpus_token_stats(spark, sf):
    return rounded_stats(ct.token_stats(documents(spark, sf), tx.words(F.col("text"))))


def preview_sql(tokens: str) -> str:
    shown = f"(case when len({tokens}) = 0 then '[]' else '[''' || array_to_string({tokens}, ''', ''') || ''']' end)"
    return f"case when length({shown}) > 40 then left({shown}, 37) || '...' else {shown} end"


@query("compared_tokenizers", " union all ".join(
    f"select conv_id * 1000 + turn as doc_id, '{name}' as tokenizer, cast(len({tokens}) as integer) as n_tokens, {preview_sql(tokens)} as preview from conversations"
    for name, tokens in (("char", "string_split(text, '')"), ("word", WORDS), ("chunk", CHUNKS))))
def compared_tokenizers(spark, sf):
    text = F.col("text")
    turns = table(spark, sf, "conversations").withColumn("doc_id", F.col("conv_id") * 1000 + F.col("turn"))
    return en.compare_tokenizers(
        turns, {"char": tx.characters(text), "word": tx.words(text), "chunk": tx.chunks(text)}
    )


@query("vocab_sample", f"select token, id from ({CHAR_VOCAB}) order by id limit 30")
def vocab_sample(spark, sf):
    return vb.sample(vb.char_vocab(documents(spark, sf))).select("token", "id")


def merged_sql(pairs: str, left: str, right: str, merged: str) -> str:
    mark = "chr(2) || '{}' || chr(3)"
    wrapped = "array_to_string(list_transform(t, lambda x: chr(2) || x || chr(3)), '')"
    return f"""with {pairs},
done as (select replace({wrapped}, {mark.format(left)} || {mark.format(right)}, {mark.format(merged)}) as s, freq from types)
select token, cast(sum(freq) as bigint) as freq
from (select unnest(regexp_extract_all(s, chr(2) || '([^' || chr(3) || ']*)' || chr(3), 1)) as token, freq from done) group by token"""


@query("merged_pair", merged_sql(CHAR_PAIRS, "l", "l", "ll"))
def merged_pair(spark, sf):
    types = ct.split_characters(ct.chunk_counts(documents(spark, sf)))
    return ct.symbol_counts(ct.merge_pair(types, "l", "l"))


@query("merged_wordpiece_pair", merged_sql(PIECE_PAIRS, "##n", "##t", "##nt"))
def merged_wordpiece_pair(spark, sf):
    types = ct.split_wordpieces(ct.stripped_word_counts(documents(spark, sf)))
    return ct.symbol_counts(ct.merge_pair(types, "##n", "##t", tx.WORDPIECE_PREFIX))


@query("one_hot_vectors", f"select id, id as idx, cast(1 as double) as value from ({word_vocab_sql(2)})")
def one_hot_vectors(spark, sf):
    from corpuskit.operators.embedding_training import one_hot

    return one_hot(vb.word_vocab(documents(spark, sf), min_freq=2))


@query("negative_weights", f"""
with v as ({word_vocab_sql(2)})
select id, round(pow(coalesce(freq, 1), 0.75) / (select sum(pow(coalesce(freq, 1), 0.75)) from v) * 1000, 6) as weight from v""")
def negative_weights(spark, sf):
    weights = vb.negative_weights(vb.word_vocab(documents(spark, sf), min_freq=2))
    return weights.select("id", rounded(F.col("weight") * 1000).alias("weight"))
