"""A training-data pipeline: grade, identify the language, drop near copies, pack.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir) and
returns a DataFrame.  All but the last return the columns of ``docs``.
"""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpuskit.llm import language, packing, quality, simhash
from corpuskit.plans.catalog import query
from corpuskit.session import checkpoint_dir, ship_package

# Least probability of being sound, and least share of the best language.
SOUND = 0.5
CLEAR = 0.5

# Trained models and packed windows are beyond SQL; the tests hold the stages against brute force.
ORACLE_SQL = None


def grade_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are sound with probability ``SOUND`` or more, by the ratings in ``labels``.

    Sound is grade 1 or 2: toxic documents of good quality stay.
    """
    ship_package(spark)
    ratings = quality.grades_of(spark.read.parquet(f"{sf_dir}/labels.parquet"))
    rows = quality.graded(docs, quality.learn(docs, ratings), least=SOUND)
    return rows.where("keep").select(docs.columns)


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with letters in a language that is told apart from the others."""
    ship_package(spark)
    rows = language.predicted(docs, language.learn(docs))
    known = (F.col("lang_pred") != language.UNKNOWN) & (F.col("score") >= CLEAR)
    return rows.where(known).select(docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: the one with the smallest id.

    Near is what op8 calls so, at most 4 of 64 bits; most pairs with a shingle
    similarity of 0.8 differ in more and stay.
    """
    ship_package(spark)
    return simhash.one_of_each(docs)


def pack_windows(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents that stayed, with their places in the training windows."""
    ship_package(spark)
    return packing.packed(docs)


STAGES = [
    ("quality", grade_quality),
    ("language", identify_language),
    ("near_copies", drop_near_copies),
    ("packing", pack_windows),
]


def settled(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """``docs``, written once to the shared folder.

    Stages read their input several times; without this each would run all models
    before it again, and so would every lost task.
    """
    path = f"{checkpoint_dir(spark)}/stage-{uuid4().hex}"
    docs.write.parquet(path)
    return spark.read.schema(docs.schema).parquet(path)


@query("pipeline", ORACLE_SQL)
def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = settled(spark, stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
