"""Cutting lineage through storage that outlives an executor, and size checks."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# How to join: the planner decides, sort-merge, or the graph on every executor.
STRATEGIES = ("auto", "shuffle", "broadcast")

# Edge rows that ``strategy="broadcast"`` may replicate to every executor. A row is
# at most five 8-byte columns, so this is about 80 MB.
BROADCAST_ROWS = 2_000_000


def shared_dir(spark: SparkSession) -> str:
    """Folder that every executor can reach, as named by ``spark.checkpoint.dir``.

    A directory set with ``SparkContext.setCheckpointDir`` is taken next. Only a
    local session without either gets a temporary folder of its own.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        configured = spark.sparkContext.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="edgeloom-"))
    return spark.sparkContext.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_dir(spark)}/edgeloom/{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once and go on from the written table.

    The result has no lineage behind it, survives the loss of executors, and is
    columnar, so later steps read only what they use.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(table: DataFrame) -> None:
    """Delete a table of ``stage`` that is not read again."""
    files = table.inputFiles()
    if files:
        context = table.sparkSession.sparkContext
        folder = context._jvm.org.apache.hadoop.fs.Path(files[0]).getParent()
        folder.getFileSystem(context._jsc.hadoopConfiguration()).delete(folder, True)


def fits_broadcast(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> bool:
    """Whether ``df`` has at most ``max_rows`` rows.

    Counts all of them: a limit would send up to ``max_rows`` rows of each task into one.
    """
    return df.count() <= max_rows


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
