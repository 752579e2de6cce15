"""Row operators on streams: encoding and scoring keep no state, so they run unchanged."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from corpuskit.operators import rollouts as ro
from corpuskit.operators.tokenizers import Tokenizer


def read_stream(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """New Parquet files below ``path`` as they arrive."""
    return spark.readStream.schema(schema).parquet(path)


def encode_stream(docs: DataFrame, model: Tokenizer, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    return docs.select(F.col(doc_id).alias("doc_id"), model.ids(F.col(text)).alias("input_ids"))


def score_stream(rollouts: DataFrame, reward: Callable[[Column], Column], threshold: float = 1.0) -> DataFrame:
    return ro.score(rollouts, reward, threshold)


def write_available(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Process what has arrived so far into Parquet, then stop."""
    return (
        stream.writeStream.format("parquet").outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start(path)
    )


def reprompt_batches(scored: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Choose demonstrations inside each micro-batch, which counts as one batch of rollouts.

    A batch owns the folder ``batch_id=<number>`` and overwrites it, so a batch that
    is replayed after a failure is not written twice.
    """

    def run(batch: DataFrame, number: int) -> None:
        rows = batch.withColumn("batch_id", F.lit(number).cast("bigint"))
        ro.reprompt(rows).drop("batch_id").write.mode("overwrite").parquet(f"{path}/batch_id={number}")

    return (
        scored.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )
