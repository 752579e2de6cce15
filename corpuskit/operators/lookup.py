"""Key lookups: broadcast behind a size check, otherwise a shuffle join safe against hot keys."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpuskit.session import BROADCAST_ROWS, cut_lineage, is_small


def lookup_join(
    rows: DataFrame,
    table: DataFrame,
    key: str,
    how: str = "left",
    limit: int = BROADCAST_ROWS,
    settled: bool = False,
) -> DataFrame:
    """Join ``rows`` to the unique-key ``table`` on ``key`` (``left``, ``inner`` or ``left_semi``).

    The table is written first, so that checking its size does not compute it
    twice; ``settled`` says that it already lies in a checkpoint.
    """
    table = table if settled else cut_lineage(table)
    if is_small(table, limit):
        return rows.join(F.broadcast(table), key, how)
    return salted_join(rows, table, key, how)


def salted_join(rows: DataFrame, table: DataFrame, key: str, how: str = "left") -> DataFrame:
    """Shuffle join in which no key outgrows a task.

    Adaptive execution splits skewed joins too, but not when what follows needs the
    rows dealt by the key, as the aggregations behind most lookups here do.
    With P shuffle partitions at most P keys can hold more than 1/P of the rows.
    Their rows are dealt to several copies of the table row, in proportion to
    their share; all other keys stay as they are.
    """
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    counts = rows.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    fair_share = counts.agg(F.sum("_n") / parts).scalar()
    copies = F.ceil(F.col("_n") / fair_share).cast("int")
    hot = cut_lineage(
        counts.where(F.col("_n") > fair_share).select(key, copies.alias("_copies"))
    )
    dealt = F.pmod(F.xxhash64(*rows.columns), F.coalesce("_copies", F.lit(1)))
    salted_rows = rows.join(F.broadcast(hot), key, "left").withColumn("_salt", dealt).drop("_copies")
    last = F.coalesce("_copies", F.lit(1)).cast("bigint") - 1
    salted_table = (
        table.join(F.broadcast(hot), key, "left")
        .withColumn("_salt", F.explode(F.sequence(F.lit(0).cast("bigint"), last)))
        .drop("_copies")
    )
    return salted_rows.join(salted_table, [key, "_salt"], how).drop("_salt")
