"""Writing and reading tokenizers and embeddings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpuskit.config import SPECIAL_TOKENS, WORDPIECE_SPECIAL_TOKENS
from corpuskit.operators.tokenizers import Tokenizer

# What joins the two parts of a merge in the JSON form, and the form of a key with escaped parts.
PAIR_MARK = "|||"
ESCAPED_KEY = r"^\|[^|]*\|\|\|[^|]*$"


def write_tables(model: Tokenizer, path: str) -> None:
    """One Parquet table per part: exact for any token."""
    spark = model.vocab.sparkSession
    meta = spark.createDataFrame([(model.kind, model.vocab_size)], "kind string, vocab_size int")
    parts = {"meta": meta, "vocab": model.vocab, "merges": model.merges, "unigram": model.unigram}
    for name, table in parts.items():
        if table is not None:
            table.write.mode("overwrite").parquet(f"{path}/{name}")


def read_tables(spark: SparkSession, path: str) -> Tokenizer:
    kind, size = spark.read.parquet(f"{path}/meta").select("kind", "vocab_size").first()
    has_merges = kind.endswith("bpe") or kind == "wordpiece"
    return Tokenizer(
        kind, size, spark.read.parquet(f"{path}/vocab"),
        spark.read.parquet(f"{path}/merges") if has_merges else None,
        spark.read.parquet(f"{path}/unigram") if kind.endswith("unigram") else None,
    )


def _as_map(table: DataFrame, key: Column, value: Column, order: str) -> DataFrame:
    """All rows of a model table (bounded by the vocabulary size) as one ordered map."""
    entries = F.array_sort(F.collect_list(F.struct(F.col(order), key.alias("k"), value.alias("v"))))
    pairs = F.transform(entries, lambda e: F.struct(e["k"].alias("key"), e["v"].alias("value")))
    return table.agg(F.map_from_entries(pairs).alias("m"))


def _escaped(token: str) -> Column:
    return F.replace(F.replace(F.col(token), F.lit("~"), F.lit("~0")), F.lit("|"), F.lit("~1"))


def _unescaped(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("~1"), F.lit("|")), F.lit("~0"), F.lit("~"))


def _pair_key(left: str, right: str) -> Column:
    """``left|||right``; with a ``|`` in a part, a leading ``|`` and both parts escaped (``~`` as ``~0``, ``|`` as ``~1``)."""
    unsafe = F.contains(left, F.lit("|")) | F.contains(right, F.lit("|"))
    return F.when(
        unsafe, F.concat(F.lit("|"), _escaped(left), F.lit(PAIR_MARK), _escaped(right))
    ).otherwise(F.concat(left, F.lit(PAIR_MARK), right))


def _pair_parts(key: str) -> tuple[Column, Column]:
    """The two parts of such a key."""
    escaped = F.rlike(key, F.lit(ESCAPED_KEY))
    plain = F.split(key, r"\|\|\|")
    inner = F.split(F.substring(key, 2, 2**30), r"\|\|\|")
    left, right = (F.when(escaped, _unescaped(inner[at])).otherwise(plain[at]) for at in (0, 1))
    return left, right


def to_json(model: Tokenizer) -> DataFrame:
    """One row, one column ``value``: the whole model as a JSON object."""
    vocab = _as_map(model.vocab, F.col("token"), F.col("id"), "id")
    row = vocab.select(F.lit(model.vocab_size).alias("vocab_size"), F.col("m").alias("vocab"))
    if model.kind.startswith("sentencepiece"):
        row = row.withColumn("mode", F.lit(model.kind.split("-")[1]))
    if model.kind.endswith("bpe"):
        merges = _as_map(model.merges, _pair_key("left", "right"), F.col("merged"), "rank")
        row = row.withColumn("merges", merges.scalar())
    else:
        row = row.withColumn("merges", F.create_map().cast("map<string,string>"))
    if model.kind.endswith("unigram"):
        ordered = model.unigram.withColumn("_o", F.col("token"))
        probs = _as_map(ordered, F.col("token"), F.col("logp"), "_o")
        row = row.withColumn("vocab_probs", probs.scalar())
    return row.select(F.to_json(F.struct("*")).alias("value"))


def write_json(model: Tokenizer, path: str) -> None:
    to_json(model).write.mode("overwrite").text(path)


JSON_SCHEMA = (
    "vocab_size int, mode string, vocab map<string,int>, merges map<string,string>, "
    "vocab_probs map<string,double>"
)


def read_json(spark: SparkSession, path: str, kind: str | None = None) -> Tokenizer:
    """A tokenizer from its JSON form.  ``kind`` is guessed from the content when not given."""
    data = spark.read.schema(JSON_SCHEMA).option("multiLine", True).json(path)
    size, mode, n_merges, n_probs, classic = data.select(
        "vocab_size", "mode", F.size("merges"), F.size("vocab_probs"),
        F.map_contains_key("vocab", F.lit("[CLS]")),
    ).first()
    if kind is None:
        if mode:
            kind = f"sentencepiece-{mode}"
        else:
            kind = "bpe" if n_merges > 0 else "unigram" if n_probs > 0 else "wordpiece" if classic else "bpe"
    special = WORDPIECE_SPECIAL_TOKENS if kind == "wordpiece" else SPECIAL_TOKENS
    vocab = data.select(F.explode("vocab").alias("token", "id")).withColumn(
        "is_special", F.col("token").isin(list(special))
    )
    merges = data.select(F.posexplode("merges").alias("rank", "key", "merged"))
    left, right = _pair_parts("key")
    merges = merges.select("rank", left.alias("left"), right.alias("right"), "merged")
    unigram = data.select(F.explode("vocab_probs").alias("token", "logp"))
    return Tokenizer(
        kind, size, vocab,
        merges if kind.endswith("bpe") else None,
        unigram if kind.endswith("unigram") else None,
    )


def write_embeddings(embeddings: DataFrame, vocab: DataFrame, path: str) -> None:
    """``(id, token, vec)`` as Parquet."""
    embeddings.join(vocab.select("id", "token"), "id", "left").select(
        "id", "token", "vec"
    ).write.mode("overwrite").parquet(path)


def read_embeddings(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)
