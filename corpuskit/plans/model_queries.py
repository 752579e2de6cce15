"""Segmenting with small fixed models, and the first steps of training, each with its SQL counterpart.

The fixed models are plain literals that both sides share; their log probabilities
are quarters, so sums are exact in any order.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from corpuskit.config import SPECIAL_TOKENS, WORDPIECE_SPECIAL_TOKENS
from corpuskit.functions import text as tx
from corpuskit.functions.subwords import UNKNOWN_LOGP
from corpuskit.operators import counts as ct
from corpuskit.operators import tokenizers as tk
from corpuskit.operators import unigram as ug
from corpuskit.operators import vocab as vb
from corpuskit.operators import windows as wn
from corpuskit.operators.merge_training import first_merges
from corpuskit.operators.tokenizers import Tokenizer
from corpuskit.plans.catalog import CHUNKS, WORDS, documents, digest, digest_sql, query, rounded, table
from corpuskit.plans.encode_queries import STREAM, vocab_and_docs, windows_sql
from corpuskit.plans.file_queries import fresh_path
from corpuskit.plans.vocab_queries import SEEDS, SPLIT_WP, counted
from corpuskit.sources import corpus, models

MARK = tx.SPACE_MARK
MERGES = [
    ("t", "h"), ("th", "e"), ("i", "n"), ("e", "r"), ("a", "n"), ("o", "n"), ("in", "g"), ("an", "d"),
    ("th", "er"), ("e", "e"), ("l", "l"), ("s", "t"), ("e", "n"), ("er", "e"), ("th", "in"),
]
MARKED_MERGES = [(MARK, "t"), (f"{MARK}t", "h"), (f"{MARK}th", "e"), ("i", "n"), (MARK, "a"), (f"{MARK}a", "n"), ("e", "r")]
PIECES = "th the in an a e i o s t n er ##e ##r ##er ##n ##t ##h ##th ##in ##an ##ing ##s ##a ##o ##i ##d ##l ##u ##g".split()
LOGP = {
    **{c: -4.0 for c in "abcdefghilnorstuy"},
    **{"th": -2.0, "the": -2.5, "in": -2.25, "er": -2.5, "an": -2.75, "on": -2.75, "ing": -3.0, "and": -3.5, "ther": -3.25, "re": -2.5, "ti": -3.0, "es": -3.0},
}
MARKED_LOGP = {MARK: -3.0, f"{MARK}the": -2.0, f"{MARK}a": -2.5, f"{MARK}th": -3.0, **LOGP}


def merges_table(spark, merges):
    rows = [(n, a, b, a + b) for n, (a, b) in enumerate(merges)]
    return spark.createDataFrame(rows, "rank int, left string, right string, merged string")


def vocab_table(spark, tokens, special=SPECIAL_TOKENS):
    rows = [(t, i, True) for t, i in special.items()] + [(t, len(special) + n, False) for n, t in enumerate(tokens)]
    return spark.createDataFrame(rows, "token string, id int, is_special boolean")


def unigram_table(spark, logp):
    return spark.createDataFrame(list(logp.items()), "token string, logp double")


def fixed(spark, kind):
    """The fixed model of a kind."""
    if kind == "wordpiece":
        return Tokenizer(kind, 0, vocab_table(spark, PIECES, WORDPIECE_SPECIAL_TOKENS))
    if kind.endswith("bpe"):
        merges = MARKED_MERGES if kind.startswith("sentencepiece") else MERGES
        letters = sorted(set("".join(a + b for a, b in merges)))
        return Tokenizer(kind, 0, vocab_table(spark, [*letters, *(a + b for a, b in merges)]), merges=merges_table(spark, merges))
    logp = MARKED_LOGP if kind.startswith("sentencepiece") else LOGP
    return Tokenizer(kind, 0, vocab_table(spark, list(logp)), unigram=unigram_table(spark, logp))


# --- SQL of the segmenters ----------------------------------------------------------------


def quoted(text):
    return "'" + text.replace("'", "''") + "'"


def marked_sql(tokens):
    return f"array_to_string(list_transform({tokens}, lambda x: chr(2) || x || chr(3)), '')"


def tokens_sql(marked):
    return f"regexp_extract_all({marked}, chr(2) || '([^' || chr(3) || ']*)' || chr(3), 1)"


def one_sql(token):
    return f"chr(2) || {token} || chr(3)"


def chain_sql(marked, merges):
    """The merges one after another, each over the whole text."""
    for a, b in merges:
        marked = f"replace({marked}, {one_sql(quoted(a))} || {one_sql(quoted(b))}, {one_sql(quoted(a + b))})"
    return marked


def model_sql(logp):
    return "map {" + ", ".join(f"{quoted(t)}: cast({p!r} as double)" for t, p in logp.items()) + "}"


def paths_sql(source, logp, name="best", beside=""):
    """CTEs for the best path of every row (word, skip) of ``source``: ``{name}(word, skip, score, toks)``.

    ``sc`` and ``st`` grow by one position a step: the best score there and where its
    last piece starts.  Starts ascend, so on equal scores the longer last piece stays.
    ``logp`` is a literal model, or the name of a map in the one-row table ``beside``.
    """
    model = logp if isinstance(logp, str) else model_sql(logp)
    beside = f", {beside}" if beside else ""
    lost = "'-inf'::double"
    piece = "substr(word, cast(s as integer) + 1, cast(e + 1 - s as integer))"
    gain = f"case when {piece} = skip then null else {model}[{piece}] end"
    return f"""{name}_dp as (
  select word, skip, 0 as e, [cast(0 as double)] as sc, [cast(0 as bigint)] as st from {source}
  union all
  select word, skip, e + 1, list_append(sc, coalesce(list_max(c), {lost})),
    list_append(st, case when coalesce(list_max(c), {lost}) = {lost} then -1 else greatest(0, e - {tx.MAX_SUBWORD - 1}) + list_position(c, list_max(c)) - 1 end)
  from (select word, skip, e, sc, st, list_transform(range(greatest(0, e - {tx.MAX_SUBWORD - 1}), e + 1), lambda s: sc[s + 1] + {gain}) as c
    from {name}_dp{beside} where e < length(word))),
{name}_end as (select word, skip, sc[e + 1] as score, st, e from {name}_dp where e = length(word)),
{name}_walk as (
  select word, skip, score, st, cast(e as bigint) as p, cast([] as varchar[]) as toks from {name}_end where score > {lost}
  union all
  select word, skip, score, st, st[p + 1], list_prepend(substr(word, cast(st[p + 1] as integer) + 1, cast(p - st[p + 1] as integer)), toks)
  from {name}_walk where p > 0),
{name} as (
  select word, skip, score, toks from {name}_walk where p = 0
  union all
  select word, skip, null, list_transform(string_split(word, ''), lambda c: case when {model}[c] is null then '<UNK>' else c end)
  from {name}_end{beside} where score = {lost})"""


TURN_WORDS = f"select distinct unnest({WORDS}) as word from conversations"
JOINED = "array_to_string(toks, chr(1)) as pieces"


def greedy_sql():
    vocab = "[" + ", ".join(map(quoted, PIECES)) + "]"
    longest = max(map(len, PIECES))
    lead = "case when p > 0 then '##' else '' end"
    fits = f"list_filter(range(1, least({longest}, length(word) - p) + 1), lambda n: list_contains({vocab}, {lead} || substr(word, p + 1, cast(n as integer))))"
    return f"""with recursive words as ({TURN_WORDS}), g as (
  select word, 0 as p, cast([] as varchar[]) as toks from words
  union all
  select word, cast(p + coalesce(n, 1) as integer), list_append(toks, case when n is null then '<UNK>' else {lead} || substr(word, p + 1, cast(n as integer)) end)
  from (select word, p, toks, list_max({fits}) as n from g where p < length(word)))
select word, {JOINED} from g where p = length(word)"""


SEGMENTS = {
    "bpe": f"with words as (select distinct unnest({CHUNKS}) as word from conversations), s as (select word, "
    f"{tokens_sql(chain_sql(marked_sql("string_split(word, '')"), MERGES))} as toks from words) select word, {JOINED} from s",
    "wordpiece": greedy_sql(),
    "unigram": f"with recursive words as (select word, '' as skip from ({TURN_WORDS})), {paths_sql('words', LOGP)} select word, {JOINED} from best",
    "sentencepiece-bpe": f"with words as (select '{MARK}' || word as word from ({TURN_WORDS})), s as (select word, "
    f"{tokens_sql(chain_sql(marked_sql("string_split(word, '')"), MARKED_MERGES))} as toks from words) select word, {JOINED} from s",
    "sentencepiece-unigram": f"with recursive words as (select '{MARK}' || word as word, '' as skip from ({TURN_WORDS})), "
    f"{paths_sql('words', MARKED_LOGP)} select word, {JOINED} from best",
}


def segments_query(kind):
    def run(spark, sf):
        model = fixed(spark, kind)
        words = table(spark, sf, "conversations", "text").select(F.explode(model.words(F.col("text"))).alias("word")).distinct()
        return words.select("word", F.array_join(model.segmenter()(F.array("word")), "\x01").alias("pieces"))

    return run


for _kind, _sql in SEGMENTS.items():
    query(f"{_kind.replace('-', '_')}_segments", _sql)(segments_query(_kind))


def known_sql():
    """Ids of the chunks' tokens, and the text of the known ones."""
    merged = [a + b for a, b in MERGES]
    tokens = [*sorted(set("".join(merged))), *merged]
    ids = "map {" + ", ".join(f"{quoted(t)}: {n + 4}" for n, t in enumerate(tokens)) + "}"
    # chr(4) stands between chunks, so that no merge reaches over their border.
    chunk = marked_sql("string_split(k, '')")
    line = f"array_to_string(list_transform({CHUNKS}, lambda k: {chunk} || chr(4)), '')"
    return f"""with s as (select doc_id, {tokens_sql(chain_sql('line', MERGES))} as toks from (select doc_id, {line} as line from documents)),
i as (select doc_id, list_transform(toks, lambda t: coalesce({ids}[t], 1)) as ids, list_filter(toks, lambda t: {ids}[t] is not null) as known from s)
select doc_id, cast(len(ids) as integer) as n, {digest_sql('ids')} as ids, md5(array_to_string(known, '')) as text from i"""


@query("bpe_known_text", known_sql())
def bpe_known_text(spark, sf):
    """Encoded with few merges and few known tokens, then decoded: unknown tokens vanish."""
    model = fixed(spark, "bpe")
    encoded = model.encode(documents(spark, sf))
    text = model.decode(encoded).select("doc_id", F.md5("text").alias("text"))
    ids = F.col("input_ids")
    return encoded.select("doc_id", F.size(ids).alias("n"), digest(ids).alias("ids")).join(text, "doc_id")


# --- losses and pruning of a fixed model --------------------------------------------------

BENCH_TYPES = "types as (select word, count(*) as freq from (select unnest(" + WORDS + ") as word from benchmark) group by word)"
SPELLED = f"list_sum(list_transform(string_split(word, ''), lambda c: coalesce({model_sql(LOGP)}[c], {UNKNOWN_LOGP!r})))"
BASE = f"{BENCH_TYPES}, words as (select word, '' as skip from types), {paths_sql('words', LOGP)}"
IMPORTANCE = f"""{BASE},
tried as (select distinct word, unnest(toks) as skip from best where score is not null),
without as (select word, skip from tried where length(skip) > 1),
{paths_sql('without', LOGP, name='rest')},
importance as (select r.skip as token, sum(freq * (b.score - coalesce(r.score, {SPELLED.replace('word', 'r.word')}))) as importance
  from rest r join best b on b.word = r.word join types t on t.word = r.word group by r.skip)"""


def bench_types(spark, sf):
    return ct.stripped_word_counts(table(spark, sf, "benchmark"), doc_id="item_id")


@query("unigram_fixed_loss", f"with recursive {BASE} select round(sum(freq * -coalesce(score, {SPELLED})), 3) as loss from (select best.word, score, freq from best join types using (word))")
def unigram_fixed_loss(spark, sf):
    return ug.corpus_loss(bench_types(spark, sf), LOGP).select(F.round("loss", 3).alias("loss"))


@query("unigram_fixed_importance", f"with recursive {IMPORTANCE} select token, round(importance, 3) + 0.0 as importance from importance")
def unigram_fixed_importance(spark, sf):
    rows = ug.token_importance(bench_types(spark, sf), LOGP)
    return rows.select("token", (F.round("importance", 3) + F.lit(0.0)).alias("importance"))


PRUNED = 3  # a quarter of the twelve longer tokens: one round
SEED_ROWS = ", ".join(f"({quoted(t)}, cast({p!r} as double), {n + 1})" for n, (t, p) in enumerate(LOGP.items()))


@query("unigram_fixed_pruned", f"""with recursive {IMPORTANCE},
seeds as (select * from (values {SEED_ROWS}) s(token, logp, seed_rank)),
gone as (select token from seeds left join importance using (token) where length(token) > 1 order by coalesce(importance, 0), seed_rank limit {PRUNED})
select token, logp from seeds where token not in (select token from gone)
union all select unnest(['<PAD>', '<UNK>', '<BOS>', '<EOS>']), round({UNKNOWN_LOGP!r}, 6)""")
def unigram_fixed_pruned(spark, sf):
    rows = [(t, p, n + 1) for n, (t, p) in enumerate(LOGP.items())]
    seeds = spark.createDataFrame(rows, "token string, logp double, seed_rank int")
    target = len(LOGP) + len(SPECIAL_TOKENS) - PRUNED
    kept = ug.prune(bench_types(spark, sf), seeds, target, ratio=0.25)
    return kept.select("token", rounded(F.col("logp")).alias("logp"))


TRAINED = 204  # as many seeds, which is four too many with the special tokens: one round of pruning


def trained_sql(word, seed_text):
    """Unigram training with one round: seeds, importance of their tokens, the four least important gone."""
    docs = "(select item_id as doc_id, text from benchmark)"
    seeds = SEEDS.replace("from documents", f"from (select doc_id, {seed_text} as text from {docs})")
    spelled = "list_sum(list_transform(string_split(r.word, ''), lambda c: coalesce(model[c], " + repr(UNKNOWN_LOGP) + ")))"
    return f"""with recursive {seeds},
seeds as (select token, logp, seed_rank from ranked where seed_rank <= {TRAINED}),
m as materialized (select map_from_entries(list({{'k': token, 'v': logp}})) as model from seeds),
types as (select word, count(*) as freq from (select {word} as word from (select unnest({WORDS}) as w from benchmark)) group by word),
words as (select word, '' as skip from types),
{paths_sql('words', 'model', beside='m')},
without as (select word, skip from (select distinct word, unnest(toks) as skip from best where score is not null) where length(skip) > 1),
{paths_sql('without', 'model', 'rest', beside='m')},
importance as (select r.skip as token, sum(freq * (b.score - coalesce(r.score, {spelled}))) as importance
  from rest r join best b on b.word = r.word join types t on t.word = r.word cross join m group by r.skip),
gone as (select token from seeds left join importance using (token) where length(token) > 1 order by coalesce(importance, 0), seed_rank limit 4)
select token, round(logp, 6) as logp from seeds where token not in (select token from gone)
union all select unnest(['<PAD>', '<UNK>', '<BOS>', '<EOS>']), round({UNKNOWN_LOGP!r}, 6)"""


def model_rows(model):
    return model.unigram.select("token", rounded(F.col("logp")).alias("logp"))


@query("unigram_trained_once", trained_sql("w", "text"))
def unigram_trained_once(spark, sf):
    return model_rows(tk.train_unigram(table(spark, sf, "benchmark"), TRAINED, doc_id="item_id", seed_factor=1))


MARKED_LINE = f"case when starts_with(text, ' ') or starts_with(text, '{MARK}') then replace(text, ' ', '{MARK}') else '{MARK}' || replace(text, ' ', '{MARK}') end"


@query("sentencepiece_trained_once", trained_sql(f"'{MARK}' || w", MARKED_LINE))
def sentencepiece_trained_once(spark, sf):
    """Seeds drawn from whole lines, which may span words."""
    return model_rows(tk.train_sentencepiece(table(spark, sf, "benchmark"), TRAINED, "unigram", doc_id="item_id", seed_factor=1))


# --- the first merges of training ---------------------------------------------------------

FIRST_MERGES = 6


def first_merges_sql(chunks, split, word="token", by_score=False):
    """Unrolled training: count, take the best pair (ties: met first), merge, count again."""
    parts = [counted(chunks, word), f"t0 as materialized (select {marked_sql(split)} as s, freq, first from counts)"]
    joined = "a || regexp_replace(b, '^##', '')" if by_score else "a || b"
    for n in range(1, FIRST_MERGES + 1):
        listed = f"(select {tokens_sql('s')} as l, freq, first from t{n - 1})"
        score = "f" if not by_score else f"f / (cast((select fs from y{n} where tok = a) as double) * cast((select fs from y{n} where tok = b) as double))"
        if by_score:
            parts.append(f"y{n} as materialized (select tok, sum(freq) as fs from (select unnest(l) as tok, freq from {listed}) group by tok)")
        parts.append(
            f"""p{n} as materialized (select a, b, sum(freq) as f, min({{'f': first, 'i': i}}) as met
  from (select l[i] as a, l[i + 1] as b, freq, first, i from (select l, freq, first, unnest(range(1, len(l))) as i from {listed})) group by a, b)"""
        )
        parts.append(f"b{n} as materialized (select a, b, {joined} as m from (select *, {score} as score from p{n}) order by score desc, met limit 1)")
        parts.append(
            f"t{n} as materialized (select replace(s, {one_sql('a')} || {one_sql('b')}, {one_sql('m')}) as s, freq, first from t{n - 1}, b{n})"
        )
    rows = " union all ".join(f'select {n - 1} as rank, a as "left", b as "right", m as merged from b{n}' for n in range(1, FIRST_MERGES + 1))
    return f"with {', '.join(parts)} {rows}"


CHARS_OF = "string_split(word, '')"


@query("bpe_first_merges", first_merges_sql(CHUNKS, CHARS_OF))
def bpe_first_merges(spark, sf):
    return first_merges(ct.chunk_counts(documents(spark, sf)), tx.characters, FIRST_MERGES, SPECIAL_TOKENS)


@query("wordpiece_first_merges", first_merges_sql(WORDS, SPLIT_WP, by_score=True))
def wordpiece_first_merges(spark, sf):
    counts = ct.stripped_word_counts(documents(spark, sf))
    return first_merges(counts, tx.wordpiece_characters, FIRST_MERGES, WORDPIECE_SPECIAL_TOKENS, tx.WORDPIECE_PREFIX, by_score=True)


@query("sentencepiece_first_merges", first_merges_sql(WORDS, CHARS_OF, f"'{MARK}' || token"))
def sentencepiece_first_merges(spark, sf):
    return first_merges(ct.marked_word_counts(documents(spark, sf)), tx.characters, FIRST_MERGES, SPECIAL_TOKENS)


# --- files, batches and draws -------------------------------------------------------------


def through_json(spark, model):
    """A model written as JSON and read back."""
    path = fresh_path(spark, "json")
    models.write_json(model, path)
    return models.read_json(spark, path)


@query("saved_trained_merges", f"select *, 'sentencepiece-bpe' as kind from ({first_merges_sql(WORDS, CHARS_OF, f"'{MARK}' || token")})")
def saved_trained_merges(spark, sf):
    """Merges trained on all documents, from the file of their model."""
    docs = documents(spark, sf)
    symbols = ct.distinct_symbols(ct.split_characters(ct.marked_word_counts(docs))).count()
    back = through_json(spark, tk.train_sentencepiece(docs, symbols + len(SPECIAL_TOKENS) + FIRST_MERGES, "bpe"))
    return back.merges.withColumn("kind", F.lit(back.kind))


@query("saved_trained_logp", f"select *, 'sentencepiece-unigram' as kind from ({trained_sql(f"'{MARK}' || w", MARKED_LINE)})")
def saved_trained_logp(spark, sf):
    """Log probabilities and mode of a model trained on the benchmark texts, from its file."""
    model = tk.train_sentencepiece(table(spark, sf, "benchmark"), TRAINED, "unigram", doc_id="item_id", seed_factor=1)
    back = through_json(spark, model)
    return model_rows(back).withColumn("kind", F.lit(back.kind))


@query("prompt_batch_sizes", """with r as (select (row_number() over () - 1) // 16 as batch_id, text from conversations where role = 'user')
select batch_id, count(*) as n, count(*) as slots, (select count(distinct (conv_id, turn)) from conversations where role = 'user') as prompts from r group by batch_id""")
def prompt_batch_sizes(spark, sf):
    """Shuffled prompts in batches of sixteen: sizes, slots, and that every prompt is dealt once."""
    prompts = table(spark, sf, "conversations").where("role = 'user'").select("conv_id", "turn")
    dealt = corpus.exact_batches(prompts, 16, "conv_id", "turn", seed=7)
    total = dealt.select("conv_id", "turn").distinct().count()
    sizes = dealt.groupBy("batch_id").agg(F.count("*").alias("n"), F.count_distinct("slot").alias("slots"))
    return sizes.withColumn("prompts", F.lit(total).cast("bigint"))


@query("pair_batch_totals", f"""with {STREAM}, {windows_sql('stream')}
select count(*) * 4 as n, least(64, count(*) * 4) as batches from win""")
def pair_batch_totals(spark, sf):
    """Training pairs dealt to 64 batches: every pair once, no batch empty."""
    vocab, docs = vocab_and_docs(spark, sf)
    pairs = wn.skipgram_pairs(wn.known_word_ids(docs, vocab))
    dealt = corpus.hashed_batches(pairs, 64, "doc_id", "pos", "slot", seed=5)
    return dealt.agg(F.count("*").alias("n"), F.count_distinct("batch_id").alias("batches"))


@query("negative_totals", f"""with {STREAM}, {windows_sql('stream')}
select count(*) * 4 * 5 as n, count(distinct target) as targets, cast(0 as bigint) as positives from win""")
def negative_totals(spark, sf):
    """Five draws for every pair, none of them the pair's own context word."""
    vocab, docs = vocab_and_docs(spark, sf)
    pairs = wn.skipgram_pairs(wn.known_word_ids(docs, vocab))
    drawn = wn.with_negatives(pairs, vb.negative_weights(vocab), k=5, seed=1)
    return drawn.agg(
        F.sum(F.size("negatives")).cast("bigint").alias("n"),
        F.count_distinct("target").alias("targets"),
        F.sum(F.array_contains("negatives", F.col("context")).cast("bigint")).alias("positives"),
    )
