"""Session helpers: where lineage is cut, how small scans are spread, what may be broadcast."""

from __future__ import annotations

import io
import tempfile
import zipfile
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Largest table (in rows) this library hands to broadcast() on its own.
BROADCAST_ROWS = 1_000_000
# Largest model table (in bytes) that is sent to the tasks to be looked up there.
FETCH_BYTES = 256 * 2**20


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors, once per Spark context.

    The archive goes to the shared folder, where every executor can fetch it.
    Unneeded where the package is installed on the executors, but harmless.
    """
    sc = spark.sparkContext
    if getattr(sc, "_corpuskit_shipped", False):
        return
    root = Path(__file__).resolve().parent
    data = io.BytesIO()
    with zipfile.ZipFile(data, "w", zipfile.ZIP_DEFLATED) as archive:
        for file in sorted(root.rglob("*.py")):
            archive.write(file, file.relative_to(root.parent))
    path = sc._jvm.org.apache.hadoop.fs.Path(
        f"{checkpoint_dir(spark)}/corpuskit-{sc.applicationId}.zip"
    )
    out = path.getFileSystem(sc._jsc.hadoopConfiguration()).create(path, True)
    out.write(data.getvalue())
    out.close()
    sc.addPyFile(path.toString())
    sc._corpuskit_shipped = True


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints, as the cluster names it.

    ``spark.checkpoint.dir`` wins.  Only a local master without that setting
    (tests, a laptop) gets a folder of its own.
    """
    sc = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if named is None:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        named = tempfile.mkdtemp(prefix="corpuskit-checkpoint-")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(named)
    return named


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: the result survives the loss of executors."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def spread(df: DataFrame) -> DataFrame:
    """Repartition a scan that has fewer splits than the cluster has cores.

    Large inputs already have plenty of splits and pass through untouched.
    """
    want = df.sparkSession.sparkContext.defaultParallelism
    if df.isStreaming or df.rdd.getNumPartitions() >= want:
        return df
    return df.repartition(want)


def row_bytes(df: DataFrame) -> Column:
    """About how many bytes a row takes: the length of its texts and arrays, 8 for anything else."""
    total = F.lit(0).cast("bigint")
    for field in df.schema:
        column, kind = F.col(f"`{field.name}`"), field.dataType.simpleString()
        if kind in ("string", "binary"):
            size = F.octet_length(column)
        elif kind == "array<string>":
            size = F.aggregate(column, F.lit(0), lambda n, x: n + 8 + F.coalesce(F.octet_length(x), F.lit(0)))
        elif kind.startswith("array"):
            size = F.size(column) * 8
        else:
            size = F.lit(8)
        total = total + F.coalesce(size, F.lit(0))
    return total


def is_small(df: DataFrame, limit: int = BROADCAST_ROWS, most_bytes: int | None = None) -> bool:
    """True when ``df`` has at most ``limit`` rows and ``most_bytes`` bytes.

    The default is what the session itself would broadcast.
    """
    if most_bytes is None:
        most_bytes = df.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    rows, size = df.agg(F.count(F.lit(1)), F.coalesce(F.sum(row_bytes(df)), F.lit(0))).first()
    return rows <= limit and size <= most_bytes


def fetch(df: DataFrame, limit: int = BROADCAST_ROWS) -> pa.Table | None:
    """The rows of ``df`` on the driver, or None when they are more than ``limit`` or too large.

    Meant for settled tables: the size is checked before anything is fetched.
    """
    return df.toArrow() if is_small(df, limit, FETCH_BYTES) else None
