"""The registry of named queries and the helpers they share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpuskit.functions import text as tx
from corpuskit.session import ship_package, spread

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

# The character classes of the SQL side.
CHUNKS = f"regexp_extract_all(text, '{tx.CHUNK_PATTERN}', 1)"
WORDS = f"regexp_extract_all(text, '{tx.WORD_PATTERN}')"
LETTER_WORDS = (
    f"list_transform(list_filter({WORDS}, lambda w: regexp_matches(w, '{tx.LETTERS_PATTERN}')), "
    "lambda w: lower(w))"
)


def stripped(sql: str) -> str:
    return f"regexp_replace({sql}, '{tx.EDGE_PATTERN}', '', 'g')"


def token_rows_sql(tokens: str, table: str = "documents", key: str = "doc_id") -> str:
    return (
        f"select {key} as doc_id, unnest(l) as token, unnest(range(len(l))) as pos "
        f"from (select {key}, {tokens} as l from {table})"
    )


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query, with the SQL that gives the same rows where there is one."""

    def register(function: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship_package(spark)
            return function(spark, sf_dir)

        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return function

    return register


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return spread(rows.select(*columns) if columns else rows)


def documents(spark: SparkSession, sf_dir: str, *more: str) -> DataFrame:
    return table(spark, sf_dir, "documents", "doc_id", "text", *more)


def embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("id"), F.col("embedding").alias("vec"), "label"
    )


def rounded(value: Column, digits: int = 6) -> Column:
    """Rounded for comparison; adding zero turns -0.0 into 0.0."""
    return F.round(value, digits) + F.lit(0.0)


def digest(items: Column) -> Column:
    """One short text for a whole array."""
    return F.md5(F.array_join(items.cast("array<string>"), "\x01"))


def digest_sql(items: str) -> str:
    return f"md5(array_to_string({items}, chr(1)))"
