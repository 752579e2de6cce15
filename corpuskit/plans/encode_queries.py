"""Tokens to ids and back, batches, spans, windows and vector lookup."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpuskit.config import SPECIAL_TOKENS
from corpuskit.functions import arrays, text as tx, vectors as vc
from corpuskit.operators import encode as en
from corpuskit.operators import vocab as vb
from corpuskit.operators import windows as wn
from corpuskit.plans.catalog import (
    LETTER_WORDS, WORDS, digest, digest_sql, documents, embeddings, query, rounded, table,
    token_rows_sql,
)
from corpuskit.plans.vocab_queries import CHAR_VOCAB, WORD_LEVEL_VOCAB, word_vocab_sql
from corpuskit.session import cut_lineage

CHARS = "string_split(text, '')"


def encoded_sql(tokens: str, vocab: str, unk: int = 1, table_name: str = "documents", key: str = "doc_id") -> str:
    """CTEs vocab, ids(doc_id, ids)."""
    return f"""vocab as ({vocab}), tok as ({token_rows_sql(tokens, table_name, key)}),
ids as (select d.{key} as doc_id, coalesce(x.ids, []) as ids from {table_name} d left join (
  select doc_id, list(coalesce(id, {unk}) order by pos) as ids from tok left join vocab using (token) group by doc_id
) x on x.doc_id = d.{key})"""


def char_encoded(spark, sf):
    docs = documents(spark, sf)
    vocab = vb.char_vocab(table(spark, sf, "benchmark", "text"))
    return en.encode_tokens(docs, tx.characters(F.col("text")), vocab), vocab


# The characters of the benchmark texts: some characters of the documents are unknown.
BENCH_CHARS = f"""select * from (values ('<PAD>', 0), ('<UNK>', 1), ('<BOS>', 2), ('<EOS>', 3)) t(token, id) union all
select token, cast(row_number() over (order by token) + 3 as integer)
from (select distinct unnest({CHARS}) as token from benchmark)"""
CHAR_IDS = encoded_sql(CHARS, BENCH_CHARS)


@query("char_encoded", f"with {CHAR_IDS} select doc_id, cast(len(ids) as integer) as n, cast(len(list_filter(ids, lambda x: x = 1)) as integer) as n_unknown, {digest_sql('ids')} as ids from ids")
def char_encoded_query(spark, sf):
    encoded, _ = char_encoded(spark, sf)
    ids = F.col("input_ids")
    return encoded.select(
        "doc_id", F.size(ids).alias("n"),
        F.size(F.filter(ids, lambda x: x == 1)).alias("n_unknown"), digest(ids).alias("ids"),
    )


def decoded_sql(ids: str, keep: str, unknown: str, join: str = "''") -> str:
    return f"""rows as (select doc_id, unnest(ids) as id, unnest(range(len(ids))) as pos from {ids}),
named as (select doc_id, pos, coalesce(token, '{unknown}') as token from rows left join vocab using (id)),
text as (select doc_id, list(token order by pos) as t from named where {keep} group by doc_id)"""


NOT_SPECIAL = "token not in ('<PAD>', '<UNK>', '<BOS>', '<EOS>')"


@query("char_decoded", f"""with {CHAR_IDS}, shifted as (select doc_id, list_transform(ids, lambda x: x + 3) as ids from ids),
{decoded_sql('shifted', 'true', '?')}
select i.doc_id, md5(coalesce(array_to_string(t, ''), '')) as text from ids i left join text using (doc_id)""")
def char_decoded(spark, sf):
    """Ids moved by three, so that some of them fall outside the vocabulary."""
    encoded, vocab = char_encoded(spark, sf)
    moved = encoded.withColumn("input_ids", F.transform("input_ids", lambda x: x + 3))
    out = en.decode(moved, vocab, unknown="?", skip=())
    return out.select("doc_id", F.md5("text").alias("text"))


def word_encoded(spark, sf):
    docs = documents(spark, sf)
    vocab = vb.word_level_vocab(table(spark, sf, "conversations", "text"))
    return en.encode_tokens(docs, tx.words(F.col("text")), vocab), vocab


TURN_WORDS = WORD_LEVEL_VOCAB.replace("from documents", "from conversations")
WORD_IDS = encoded_sql(WORDS, f"select token, id from ({TURN_WORDS})")


@query("word_encoded", f"with {WORD_IDS} select doc_id, cast(len(ids) as integer) as n, cast(len(list_filter(ids, lambda x: x = 1)) as integer) as n_unknown, {digest_sql('ids')} as ids from ids")
def word_encoded_query(spark, sf):
    encoded, _ = word_encoded(spark, sf)
    ids = F.col("input_ids")
    return encoded.select(
        "doc_id", F.size(ids).alias("n"),
        F.size(F.filter(ids, lambda x: x == 1)).alias("n_unknown"), digest(ids).alias("ids"),
    )


@query("word_decoded", f"""with {WORD_IDS}, {decoded_sql('ids', 'true', '<UNK>')}
select i.doc_id, md5(coalesce(array_to_string(t, ''), '')) as text from ids i left join text using (doc_id)""")
def word_decoded(spark, sf):
    encoded, vocab = word_encoded(spark, sf)
    return en.decode(encoded, vocab, skip=()).select("doc_id", F.md5("text").alias("text"))


@query("decoded_without_special", f"""with {WORD_IDS}, {decoded_sql('ids', NOT_SPECIAL, '<UNK>')}
select i.doc_id, md5(coalesce(array_to_string(t, ''), '')) as text from ids i left join text using (doc_id)""")
def decoded_without_special(spark, sf):
    encoded, vocab = word_encoded(spark, sf)
    return en.decode(encoded, vocab).select("doc_id", F.md5("text").alias("text"))


@query("token_ids_by_join", f"with {WORD_IDS} select id, count(*) as n from (select unnest(ids) as id from ids) group by id")
def token_ids_by_join(spark, sf):
    """The lookup for vocabularies too large to send around: a join by token, hot tokens apart."""
    vocab = vb.word_level_vocab(table(spark, sf, "conversations", "text"))
    rows = en.token_rows(documents(spark, sf), tx.words(F.col("text")))
    found = en.lookup_join(rows, vocab.select("token", "id"), "token", limit=1000, settled=True)
    return found.groupBy(F.coalesce("id", F.lit(1)).alias("id")).agg(F.count("*").alias("n"))


FINISHED = "list_slice(list_concat(list_concat([2], ids), [3]), 1, 64)"


@query("encoded_with_markers", f"""with {WORD_IDS}, cut as (select doc_id, {FINISHED} as ids from ids)
select doc_id, {digest_sql("list_concat(ids, list_transform(range(64 - len(ids)), lambda x: 0))")} as ids,
  list_contains(ids, 3) as has_end from cut""")
def encoded_with_markers(spark, sf):
    encoded, _ = word_encoded(spark, sf)
    ids = arrays.finish_ids(F.col("input_ids"), 64, True, SPECIAL_TOKENS["<BOS>"], SPECIAL_TOKENS["<EOS>"])
    return encoded.select("doc_id", digest(ids).alias("ids"), F.array_contains(ids, 3).alias("has_end"))


@query("padded_batches", f"""with {WORD_IDS}, b as (select doc_id, doc_id // 16 as batch_id, ids from ids),
longest as (select batch_id, least(max(len(ids)), 512) as n from b group by batch_id),
fixed as (select batch_id, doc_id, n, len(ids) as had,
  list_slice(list_concat(ids, list_transform(range(greatest(n - len(ids), 0)), lambda x: 0)), 1, n) as ids from b join longest using (batch_id))
select batch_id, doc_id, cast(n as integer) as n, {digest_sql('ids')} as ids, cast(least(had, n) as integer) as n_real,
  {digest_sql('list_transform(range(n), lambda i: case when i < had then 1 else 0 end)')} as mask from fixed""")
def padded_batches(spark, sf):
    encoded, _ = word_encoded(spark, sf)
    batches = encoded.withColumn("batch_id", F.floor(F.col("doc_id") / 16))
    out = en.pad_batches(cut_lineage(batches), max_length=512)
    mask = F.col("attention_mask")
    return out.select(
        "batch_id", "doc_id", F.size(mask).alias("n"), digest(F.col("input_ids")).alias("ids"),
        F.size(F.filter(mask, lambda x: x == 1)).alias("n_real"), digest(mask).alias("mask"),
    )


@query("wordpieces_joined", f"select doc_id, md5(array_to_string({WORDS}, ' ')) as text from documents")
def wordpieces_joined(spark, sf):
    """Words cut into pieces and glued again: one blank between words."""
    pieces = F.flatten(F.transform(tx.words(F.col("text")), lambda w: tx.wordpiece_characters(w)))
    return documents(spark, sf).select("doc_id", F.md5(en.joined_text(pieces, "wordpiece")).alias("text"))


@query("marked_words_joined", f"select doc_id, md5(array_to_string({WORDS}, ' ')) as text from documents")
def marked_words_joined(spark, sf):
    words = F.transform(tx.words(F.col("text")), lambda w: F.concat(F.lit(tx.SPACE_MARK), w))
    return documents(spark, sf).select("doc_id", F.md5(en.joined_text(words, "marked")).alias("text"))


@query("token_spans", f"""with t as ({token_rows_sql(WORDS)}),
s as (select doc_id, pos, token, sum(length(token)) over (partition by doc_id order by pos) as "end" from t)
select line, marker, count(*) as n, cast(sum("end") as bigint) as ends, cast(sum(start) as bigint) as starts from (
  select *, "end" - length(token) as start, cast(("end" - length(token)) // 60 as integer) as line, cast(pos % 36 as integer) as marker from s) group by line, marker""")
def token_spans(spark, sf):
    spans = en.token_spans(documents(spark, sf), tx.words(F.col("text")))
    return spans.groupBy("line", "marker").agg(
        F.count("*").alias("n"), F.sum("end").alias("ends"), F.sum("start").alias("starts")
    )


@query("token_id_lengths", f"""with vocab as ({CHAR_VOCAB}), t as ({token_rows_sql(CHARS, 'benchmark', 'item_id')})
select doc_id, pos, token, id, cast(length(token) as integer) as n_chars from t join vocab using (token)""")
def token_id_lengths(spark, sf):
    rows = en.token_rows(table(spark, sf, "benchmark"), tx.characters(F.col("text")), "item_id")
    vocab = vb.char_vocab(documents(spark, sf))
    joined = en.token_ids(rows, vocab)
    return joined.select("doc_id", F.col("pos").cast("bigint").alias("pos"), "token", "id", F.length("token").alias("n_chars"))


# Words of the conversations met three times or more, looked up in the vector table: rarer words are
# unknown and share id 0 with the padding, ids beyond the table have no vector.
TURN_WORD_IDS = word_vocab_sql(3).replace("from documents", "from (select conv_id * 1000 + turn as doc_id, text from conversations)")
EMBEDDED = f"""vocab as (select token, id from ({TURN_WORD_IDS})), t as ({token_rows_sql(LETTER_WORDS, 'benchmark', 'item_id')}),
found as (select doc_id, pos, coalesce(id, 0) as id, case when coalesce(id, 0) = 0 then list_transform(range(64), lambda i: cast(0 as double))
  else cast(embedding as double[]) end as vec from t left join vocab using (token) left join embeddings on vec_id = id)"""


def embedded(spark, sf):
    bench = table(spark, sf, "benchmark")
    turns = table(spark, sf, "conversations").withColumn("doc_id", F.col("conv_id") * 1000 + F.col("turn"))
    vocab = vb.word_vocab(turns, min_freq=3)
    rows = en.token_ids(en.token_rows(bench, tx.letter_words(F.col("text")), "item_id"), vocab, 0)
    return en.embed_tokens(rows, embeddings(spark, sf), pad_id=0, size=64)


@query("embedded_tokens", f"with {EMBEDDED} select doc_id, pos, id, round(list_sum(vec), 6) as total from found")
def embedded_tokens(spark, sf):
    return embedded(spark, sf).select(
        "doc_id", F.col("pos").cast("bigint").alias("pos"), "id", rounded(vc.total(F.col("vec"))).alias("total")
    )


@query("mean_token_vectors", f"with {EMBEDDED} select doc_id, round(avg(vec[1]), 6) as first, round(avg(vec[64]), 6) as last from found group by doc_id")
def mean_token_vectors(spark, sf):
    means = en.mean_vectors(embedded(spark, sf), "doc_id", 64)
    return means.select("doc_id", rounded(F.col("vec")[0]).alias("first"), rounded(F.col("vec")[63]).alias("last"))


# --- context windows ----------------------------------------------------------------------

STREAM = f"""vocab as ({word_vocab_sql(2)}),
words as (select doc_id, pos, id from ({token_rows_sql(LETTER_WORDS)}) left join vocab using (token)),
stream as (select doc_id, id, row_number() over (partition by doc_id order by pos) - 1 as pos from words where id is not null)"""


def vocab_and_docs(spark, sf):
    docs = documents(spark, sf)
    return vb.word_vocab(docs, min_freq=2), docs


@query("known_word_stream", f"with {STREAM} select doc_id, count(*) as n, {digest_sql('list(id order by pos)')} as ids from stream group by doc_id")
def known_word_stream(spark, sf):
    vocab, docs = vocab_and_docs(spark, sf)
    ids = F.col("input_ids")
    return wn.known_word_ids(docs, vocab).where(F.size(ids) > 0).select(
        "doc_id", F.size(ids).cast("bigint").alias("n"), digest(ids).alias("ids")
    )


def windows_sql(source: str) -> str:
    """CTE win(doc_id, pos, target, c1..c4) of full windows of two words on each side."""
    return f"""win as (select * from (select doc_id, pos, id as target,
  lag(id, 2) over w as c1, lag(id) over w as c2, lead(id) over w as c3, lead(id, 2) over w as c4,
  row_number() over w as rn, count(*) over (partition by doc_id) as size
  from {source} window w as (partition by doc_id order by pos)) where rn > 2 and rn <= size - 2)"""


KNOWN = "coalesce(id, -1) as id"


@query("cbow_pairs", f"""with {STREAM}, open as (select doc_id, pos, {KNOWN} from words), {windows_sql('open')}
select doc_id, target, count(*) as n, cast(sum(pos) as bigint) as positions,
  cast(sum(greatest(c1, 0) + 2 * greatest(c2, 0) + 3 * greatest(c3, 0) + 4 * greatest(c4, 0)) as bigint) as contexts
from win where target >= 0 group by doc_id, target""")
def cbow_pairs(spark, sf):
    """Windows over all letter words; the target must be known, unknown neighbours become 0."""
    vocab, docs = vocab_and_docs(spark, sf)
    pairs = wn.cbow_pairs(wn.word_ids(docs, vocab))
    c = F.col("context")
    return pairs.groupBy("doc_id", "target").agg(
        F.count("*").alias("n"), F.sum("pos").alias("positions"),
        F.sum(c[0] + 2 * c[1] + 3 * c[2] + 4 * c[3]).alias("contexts"),
    )


@query("skipgram_pairs", f"""with {STREAM}, open as (select doc_id, pos, {KNOWN} from words), {windows_sql('open')},
pairs as (select target, unnest([greatest(c1, 0), greatest(c2, 0), greatest(c3, 0), greatest(c4, 0)]) as context from win where target >= 0)
select target, context, count(*) as n from pairs group by target, context""")
def skipgram_pairs(spark, sf):
    """How often every target word is seen with every context word."""
    vocab, docs = vocab_and_docs(spark, sf)
    pairs = wn.skipgram_pairs(wn.word_ids(docs, vocab))
    return pairs.groupBy("target", "context").agg(F.count("*").alias("n"))


@query("context_pairs", f"""with {STREAM}, {windows_sql('stream')}
select 'cbow' as mode, target, count(*) as n, cast(sum(c1 + c2 + c3 + c4) as bigint) as total from win group by target
union all
select 'skipgram', target, 4 * count(*), cast(sum(c1 + c2 + c3 + c4) as bigint) from win group by target""")
def context_pairs(spark, sf):
    """Windows over the stream of known words, in both forms."""
    vocab, docs = vocab_and_docs(spark, sf)
    ids = wn.known_word_ids(docs, vocab)
    cbow = wn.context_pairs(ids, mode="cbow").groupBy("target").agg(
        F.count("*").alias("n"),
        F.sum(F.aggregate("context", F.lit(0), lambda a, x: a + x)).alias("total"),
    )
    skipgram = wn.context_pairs(ids, mode="skipgram").groupBy("target").agg(
        F.count("*").alias("n"), F.sum("context").alias("total")
    )
    return cbow.select(F.lit("cbow").alias("mode"), "*").unionByName(
        skipgram.select(F.lit("skipgram").alias("mode"), "*")
    )


@query("negative_samples")
def negative_samples(spark, sf):
    vocab, docs = vocab_and_docs(spark, sf)
    pairs = wn.skipgram_pairs(wn.known_word_ids(docs, vocab))
    drawn = wn.with_negatives(pairs, vb.negative_weights(vocab), k=5, seed=1)
    return drawn.select(F.explode("negatives").alias("id")).groupBy("id").agg(F.count("*").alias("n"))
