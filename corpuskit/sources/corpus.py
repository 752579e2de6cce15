"""Reading corpora, repeating them, and ordering or batching rows reproducibly."""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpuskit.operators.lookup import lookup_join
from corpuskit.operators.numbering import dense_ids
from corpuskit.session import spread


def read_text(spark: SparkSession, path: str) -> DataFrame:
    """Text files, one row per file: ``(doc_id, text)``; ids follow the file name.

    Only the names are sorted and numbered; the texts stay where they are read.
    """
    files = spark.read.text(path, wholetext=True).select(
        F.input_file_name().alias("path"), F.col("value").alias("text")
    )
    names = spark.read.text(path, wholetext=True).select(F.input_file_name().alias("path"))
    numbers = dense_ids(names, "path", id_type="bigint")
    return lookup_join(files, numbers, "path", "inner", settled=True).select(F.col("id").alias("doc_id"), "text")


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Text files, one row per line, for files too large for one row: ``(doc_id, text)``.

    A line's id is the number of lines in the splits before its own plus its place
    in the split.  The driver sees one count per split; the texts do not move.
    """
    lines = spark.read.text(path).select(
        F.input_file_name().alias("path"), F.input_file_block_start().alias("split"),
        F.monotonically_increasing_id().alias("at"), F.col("value").alias("text"),
    )
    splits = lines.groupBy("path", "split").agg(F.min("at").alias("low"), F.count("*").alias("n"))
    counted = sorted((r["path"], r["split"], r["low"], r["n"]) for r in splits.collect())
    starts = accumulate([0] + [n for *_, n in counted])
    base = spark.createDataFrame(
        [(p, s, start - low) for (p, s, low, _), start in zip(counted, starts)], "path string, split bigint, base bigint"
    )
    numbered = lines.join(F.broadcast(base), ["path", "split"])  # one row per split
    return numbered.select((F.col("base") + F.col("at")).alias("doc_id"), "text")


def read_documents(spark: SparkSession, path: str, *columns: str) -> DataFrame:
    """Parquet documents; only the asked columns are scanned."""
    return spread(spark.read.parquet(path).select(*(columns or ("doc_id", "text"))))


def repeat(docs: DataFrame, times: int) -> DataFrame:
    """Every row ``times`` times, told apart by ``copy``."""
    return docs.withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(times - 1))))


def shuffle_key(*keys: Column, seed: int = 0) -> Column:
    """A fixed pseudo random number per row: same order on any cluster layout."""
    return F.xxhash64(*keys, F.lit(seed))


def shuffled(df: DataFrame, *keys: str, seed: int = 0) -> DataFrame:
    """Rows in a reproducible random order (a range sort, not one partition)."""
    return df.orderBy(shuffle_key(*[F.col(k) for k in keys], seed=seed), *keys)


def hashed_batches(df: DataFrame, n_batches: int, *keys: str, seed: int = 0) -> DataFrame:
    """Add ``batch_id`` by hash: no shuffle, batch sizes vary a little."""
    key = shuffle_key(*[F.col(k) for k in keys], seed=seed)
    return df.withColumn("batch_id", F.pmod(key, F.lit(n_batches)).cast("int"))


def exact_batches(df: DataFrame, batch_size: int, *keys: str, seed: int = 0) -> DataFrame:
    """Add ``batch_id`` and ``slot`` after a shuffle, every batch but the last one full."""
    order = F.struct(shuffle_key(*[F.col(k) for k in keys], seed=seed), *keys)
    numbered = dense_ids(df.withColumn("_order", order), "_order", id_type="bigint")
    return (
        numbered.withColumn("batch_id", F.floor(F.col("id") / batch_size).cast("bigint"))
        .withColumn("slot", F.pmod("id", F.lit(batch_size)).cast("int"))
        .drop("_order", "id")
    )
