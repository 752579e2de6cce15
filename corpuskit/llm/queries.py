"""The registered queries of this subpackage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpuskit.llm import (
    binary_codes,
    filter_audit,
    language,
    licences,
    packing,
    perspectives,
    quality,
    rule_cascade,
    sampled_pieces,
    simhash,
    threshold_search,
    token_files,
    turn_repair,
)
from corpuskit.llm.repair_sql import REPAIR_SQL
from corpuskit.plans.catalog import query


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query("op1_sampled_pieces")
def sampled_piece_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    encoded = sampled_pieces.encode(read(spark, sf_dir, "documents").select("doc_id", "text"))
    rows = sampled_pieces.decode(encoded)
    return rows.select(
        "doc_id",
        F.size("piece_ids").cast("bigint").alias("n_pieces"),
        F.xxhash64("piece_ids").alias("ids_hash"),
        F.md5("decoded").alias("decoded_md5"),
        (F.col("decoded") == F.coalesce("text", F.lit(""))).alias("lossless"),
    )


DEDUP_SQL = """
with recursive v as (select vec_id, cast(embedding as double[]) as e from embeddings),
l as (select a.vec_id as u, b.vec_id as w from v a join v b on a.vec_id <> b.vec_id
  where list_cosine_similarity(a.e, b.e) >= 0.95),
r(u, w) as (select vec_id, vec_id from v union select r.u, l.w from r join l on r.w = l.u),
c as (select u as vec_id, min(w) as component_id from r group by u)
select c.vec_id, (select count(*) from l where l.u = c.vec_id) as n_links, component_id, c.vec_id = component_id as kept
from c
"""


@query("op2_itq_dedup", DEDUP_SQL)
def itq_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return binary_codes.near_duplicates(read(spark, sf_dir, "embeddings"))


TOP_SQL = """
with v as (select vec_id, list_transform(embedding, lambda x: floor(1024 * cast(x as double))) as e from embeddings),
s as (select a.vec_id as query_id, b.vec_id, cast(list_dot_product(a.e, b.e) as bigint) as score
  from v a join v b on a.vec_id <> b.vec_id where a.vec_id % 100 = 0),
t as (select *, cast(row_number() over (partition by query_id order by score desc, vec_id) as integer) as rank from s)
select query_id, rank, vec_id, score from t where rank <= 10
"""


@query("op3_threshold_topk", TOP_SQL)
def threshold_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return threshold_search.top_k(read(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


@query("op4_language_id")
def language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    rest = F.crc32(F.col("doc_id").cast("string")) % 4
    docs = read(spark, sf_dir, "documents")
    trees = language.learn(docs.where(rest != 2))
    rows = language.predicted(docs.select("doc_id", "text"), trees)
    return rows.select("doc_id", F.coalesce(rest == 2, F.lit(False)).alias("held_out"), "lang_pred", "score")


@query("op5_quality_grade")
def quality_grade(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality.learn(docs, quality.grades_of(read(spark, sf_dir, "labels")))
    return quality.graded(docs, model).drop("text")


def joined(labels: Column) -> Column:
    return F.array_join(F.array_sort(F.array_distinct(labels)), ",")


@query("op6_license_scan")
def license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = licences.scan(read(spark, sf_dir, "documents"))
    starts, found = F.col("base.start"), F.col("base.label")
    named = F.when(F.size("base") > 0, 1.0).otherwise(0.0)
    return rows.select(
        "doc_id",
        "n_words",
        F.size("base").cast("bigint").alias("n_base"),
        F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"),
        joined(found).alias("base_labels"),
        joined(F.concat(found, F.col("spans.label"))).alias("labels"),
        F.greatest(named, F.coalesce(F.array_max("spans.share"), F.lit(0.0))).alias("score"),
        F.size("spans").cast("bigint").alias("n_spans"),
    )


CHAT_SQL = r"""
with said as (select conv_id, turn, coalesce(nullif(trim(role), ''), 'unknown') as speaker, coalesce(text, '') as text from conversations),
people as (select distinct conv_id, speaker as perspective from said where speaker <> 'system'),
heads as (select conv_id, turn, speaker, perspective, speaker = perspective as own, text,
    case when speaker = 'system' then '<|system|>' when speaker = perspective then '<|assistant|>'
      else '<|user name=' || url_encode(speaker) || '|>' end || chr(10) as header
  from said join people using (conv_id)),
made as (select *, header || regexp_replace(text, '<(\\*)\|', '<\1\\|', 'g') || '<|end|>' || chr(10) as segment from heads),
placed as (select *, length(segment) as chars, coalesce(sum(length(segment)) over (partition by conv_id, perspective
    order by turn, speaker, segment rows between unbounded preceding and 1 preceding), 0) as start from made),
parts as (select *, start // 32768 as part, min(start) over (partition by conv_id, perspective, start // 32768) as first from placed)
select conv_id, perspective, cast(part as bigint) as part, cast(any_value(first) as bigint) as start, count(*) as n_turns,
  cast(sum(chars) as bigint) as n_chars,
  cast(coalesce(sum(chars - 1 - length(header)) filter (own), 0) as bigint) as n_masked,
  coalesce(string_agg((start - first + length(header)) || '-' || (start - first + chars - 1), ',' order by start) filter (own), '') as spans,
  md5(string_agg(segment, '' order by start)) as text_md5
from parts group by conv_id, perspective, part
"""


@query("op7_perspective_chat", CHAT_SQL)
def perspective_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = perspectives.examples(perspectives.segments(read(spark, sf_dir, "conversations")))
    masked = F.aggregate("mask", F.lit(0).cast("bigint"), lambda n, m: n + m["end"] - m["first"])
    spans = F.transform("mask", lambda m: F.concat_ws("-", m["first"].cast("string"), m["end"].cast("string")))
    return rows.select(
        "conv_id",
        "perspective",
        "part",
        "start",
        F.col("n_turns").cast("bigint").alias("n_turns"),
        F.length("text").cast("bigint").alias("n_chars"),
        masked.alias("n_masked"),
        F.array_join(spans, ",").alias("spans"),
        F.md5("text").alias("text_md5"),
    )


@query("op8_simhash_dedup")
def simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = simhash.near_duplicates(read(spark, sf_dir, "documents"))
    digits = F.lpad(F.lower(F.hex("fp")), 16, "0")
    return rows.select("doc_id", digits.alias("fingerprint"), "component_id")


@query("op9_packed_sequences")
def packed_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed(read(spark, sf_dir, "documents"))


@query("op10_token_files")
def token_file_digests(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.round_trip(read(spark, sf_dir, "documents"))


@query("op11_turn_repair", REPAIR_SQL)
def turn_repairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = read(spark, sf_dir, "conversations")
    return turn_repair.report(turn_repair.repaired(turns, turn_repair.damaged(turns)))


AUDIT_SQL = r"""
with d as (select doc_id, coalesce(source, '') as part, coalesce(text, '') as text from documents),
w as (select *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') as words, min(doc_id) over (partition by text) as least from d),
f as (select doc_id, part, case when len(words) < 200 then 1 else 0 end
  + case when 100 * len(list_distinct(words)) < 50 * len(words) then 2 else 0 end
  + case when 100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 2 * length(text) then 4 else 0 end
  + case when regexp_matches(text, '[#$%&*|]') then 8 else 0 end
  + case when doc_id > least then 16 else 0 end as mask from w),
l as (select doc_id, max((quality = 1)::int) as good, max((toxic = 1)::int) as toxic from labels group by doc_id),
c as (select part, mask, count(*) as n, coalesce(sum(good), 0) as good, coalesce(sum(toxic), 0) as toxic from f left join l using (doc_id) group by part, mask),
x as (select unnest(['A', 'B', 'C', 'D', 'E']) as x, unnest([1, 2, 4, 8, 16]) as bit),
p as (select a.x || b.x || c.x || d.x || e.x as filter_order from x a, x b, x c, x d, x e
  where (a.bit | b.bit | c.bit | d.bit | e.bit) = 31),
s as (select filter_order, step, filter_order[step] as x, (select bit from x where x.x = filter_order[step]) as own,
  coalesce((select sum(bit) from x where contains(filter_order[:step - 1], x.x)), 0)::bigint as before from p, (select unnest(range(1, 6))::int as step)),
r as (select part, filter_order, step, own, sum(case when mask & own = 0 and mask & before = 0 then n else 0 end) as kept,
  sum(case when mask & own <> 0 and mask & before = 0 then n else 0 end) as removed,
  sum(case when mask & own <> 0 and mask & before <> 0 then n else 0 end) as redundant,
  sum(case when mask = own then n else 0 end) as unique_fails,
  sum(case when mask & own <> 0 and mask & before = 0 then good else 0 end) as good_lost,
  sum(case when mask & own <> 0 and mask & before = 0 then toxic else 0 end) as toxic_lost
  from c, s group by part, filter_order, step, own)
select part, filter_order, step, kept::bigint as kept, removed::bigint as removed, redundant::bigint as redundant,
  unique_fails::bigint as unique_fails, good_lost::bigint as good_lost, toxic_lost::bigint as toxic_lost,
  (sum(removed) over (partition by part, own))::bigint as shapley from r
"""


@query("op12_filter_audit", AUDIT_SQL)
def filter_interactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


RULES_SQL = r"""
with t as (select row_number() over () as k, doc_id, coalesce(text, '') as text from documents),
w as (select *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') as words,
  list_filter(string_split(text, chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) as lines from t),
v as (select k, unnest(range(1, len(words) - 1)) as i, unnest(list_transform(range(1, len(words) - 1), lambda i: words[i:i + 2])) as three from w),
a as (select k, i, count(*) over (partition by k, three) as times from v),
c as (select k, count(distinct j) as n_repeat_words from (select k, unnest([i, i + 1, i + 2]) as j from a where times > 1) group by k),
m as (select doc_id, len(words) as n_words, length(array_to_string(words, '')) as word_chars,
  length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) as n_symbols, len(lines) as n_lines,
  len(lines) - len(list_distinct(lines)) as n_dup_lines, coalesce(n_repeat_words, 0) as n_repeat_words from w left join c using (k)),
b as (select *, n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed from m)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  not (base_failed or 10 * n_symbols > n_words or word_chars < 3 * n_words or word_chars > 10 * n_words or 100 * n_dup_lines > 50 * n_lines) as kept
from b
"""


@query("op13_rule_cascade", RULES_SQL)
def quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    rows = rule_cascade.judged(docs, rule_cascade.plan(docs), report=True)
    figures = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    return rows.select("doc_id", *figures, "base_failed", "kept")
