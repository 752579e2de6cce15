"""Vocabularies: special tokens first, then sorted tokens with dense ids."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corpuskit.config import SPECIAL_TOKENS, WORD_SPECIAL_TOKENS
from corpuskit.functions import text as tx
from corpuskit.operators import counts as ct
from corpuskit.operators.numbering import dense_ids


def special_rows(spark: SparkSession, special: dict[str, int]) -> DataFrame:
    return spark.createDataFrame(
        [(token, i, True) for token, i in special.items()], "token string, id int, is_special boolean"
    )


def symbol_vocab(symbols: DataFrame, special: dict[str, int] | None = None) -> DataFrame:
    """Vocabulary over single symbols.

    There are at most as many symbols as code points (twice that with a
    continuation prefix), so numbering them in one partition is bounded.
    """
    special = SPECIAL_TOKENS if special is None else special
    fresh = symbols.select("token").distinct()
    if special:
        fresh = fresh.where(~F.col("token").isin(list(special)))
    number = F.row_number().over(Window.orderBy("token")) + (len(special) - 1)
    numbered = fresh.select("token", number.cast("int").alias("id"), F.lit(False).alias("is_special"))
    return special_rows(symbols.sparkSession, special).unionByName(numbered) if special else numbered


def large_vocab(tokens: DataFrame, special: dict[str, int] | None = None) -> DataFrame:
    """Vocabulary over any number of tokens; further columns of ``tokens`` are kept."""
    special = SPECIAL_TOKENS if special is None else special
    fresh = tokens.where(~F.col("token").isin(list(special))) if special else tokens
    numbered = dense_ids(fresh, "token", len(special)).withColumn("is_special", F.lit(False))
    if not special:
        return numbered
    return special_rows(tokens.sparkSession, special).unionByName(
        numbered, allowMissingColumns=True
    )


def char_vocab(docs: DataFrame, text: str = "text", special: dict[str, int] | None = None) -> DataFrame:
    """Vocabulary of all characters of the raw text."""
    # At most one row per document and distinct character leaves the split.
    chars = docs.select(F.explode(F.array_distinct(tx.characters(F.col(text)))).alias("token"))
    return symbol_vocab(chars, special)


def word_level_vocab(docs: DataFrame, text: str = "text", special: dict[str, int] | None = None) -> DataFrame:
    """Vocabulary of all distinct words between white space."""
    words = docs.select(F.explode(F.array_distinct(tx.words(F.col(text)))).alias("token")).distinct()
    return large_vocab(words, special)


def word_vocab(
    docs: DataFrame,
    text: str = "text",
    min_freq: int = 1,
    special: dict[str, int] | None = None,
    doc_id: str = "doc_id",
) -> DataFrame:
    """Vocabulary of lowercased letter words seen at least ``min_freq`` times, with ``freq``."""
    counts = ct.letter_word_counts(docs, text, doc_id).where(F.col("freq") >= min_freq)
    tokens = counts.select(F.col("word").alias("token"), "freq")
    return large_vocab(tokens, WORD_SPECIAL_TOKENS if special is None else special)


def invert(vocab: DataFrame) -> DataFrame:
    """``(id, token)``; were an id given twice, the token listed last by name would stay."""
    return vocab.groupBy("id").agg(F.max("token").alias("token"))


def sample(vocab: DataFrame, n: int = 30) -> DataFrame:
    """The first ``n`` entries by id."""
    return vocab.orderBy("id").limit(n)


def probabilities(unigram: DataFrame) -> DataFrame:
    """Token probabilities from log probabilities."""
    return unigram.withColumn("prob", F.exp("logp"))


def probability_of(tokens: DataFrame, unigram: DataFrame) -> DataFrame:
    """Probability per asked token, 0 for tokens outside the model."""
    return tokens.join(unigram.select("token", "logp"), "token", "left").withColumn(
        "prob", F.coalesce(F.exp("logp"), F.lit(0.0))
    ).drop("logp")


def top_probabilities(unigram: DataFrame, n: int = 10) -> DataFrame:
    return probabilities(unigram).orderBy(F.desc("logp"), "token").limit(n)


def negative_weights(vocab: DataFrame, power: float = 0.75) -> DataFrame:
    """``(id, weight)`` proportional to ``freq ** power``; a missing frequency counts as 1."""
    raw: Column = F.pow(F.coalesce(F.col("freq"), F.lit(1)).cast("double"), F.lit(power))
    total = vocab.agg(F.sum(raw)).scalar()
    return vocab.select("id", (raw / total).alias("weight"))
