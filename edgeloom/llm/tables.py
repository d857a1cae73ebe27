"""Written tables and sorted runs that several operators use."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType

from edgeloom.plans import stage

_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


def written(df: DataFrame, name: str) -> DataFrame:
    """``stage(df, name)``, after which the shuffle files of that job are no longer kept."""
    conf = df.sparkSession.conf
    before = conf.get(_CLEANUP, "false")
    conf.set(_CLEANUP, "true")
    try:
        return stage(df, name)
    finally:
        conf.set(_CLEANUP, before)


@contextmanager
def small_batches(spark: SparkSession, size: str = "4m") -> Iterator[None]:
    """Jobs that run within send batches of about ``size`` to Python, or of one row that is larger."""
    before = spark.conf.get(_BATCH_BYTES)
    spark.conf.set(_BATCH_BYTES, size)
    try:
        yield
    finally:
        spark.conf.set(_BATCH_BYTES, before)


def by_key(rows: DataFrame, hot: list[int]) -> DataFrame:
    """``rows`` with all rows of a key, the first column, in one partition, in the order of their columns but bytes.

    Rows of ``hot`` keys, of which there are few, are spread over partitions.
    """
    first = F.col(rows.columns[0])
    salt = F.when(first.isin(hot), F.xxhash64(*rows.columns) % 1024).otherwise(F.lit(0)) if hot else F.lit(0)
    plain = [f.name for f in rows.schema if not isinstance(f.dataType, BinaryType)]
    return rows.repartition(first, salt).sortWithinPartitions(*plain)


def repeated_keys(rows: DataFrame, hot: list[int]) -> DataFrame:
    """The rows whose first column occurs in more than one of them, and those of ``hot`` keys."""
    def keep(batches):
        often = np.array(sorted(hot), np.int64)
        held, held_same = None, False
        for batch in batches:
            if held is not None:
                batch = joined(held, batch)
            if not batch.num_rows:
                continue
            key = batch.column(0).to_numpy()
            same = key[1:] == key[:-1]
            before = np.concatenate([[held_same], same])
            wanted = before[:-1] | same | np.isin(key[:-1], often)
            yield batch.slice(0, len(key) - 1).filter(pa.array(wanted))
            held, held_same = batch.slice(len(key) - 1), bool(before[-1])
        if held is not None and (held_same or held.column(0)[0].as_py() in hot):
            yield held

    return by_key(rows, hot).mapInArrow(keep, rows.schema)


def joined(first: pa.RecordBatch, second: pa.RecordBatch) -> pa.RecordBatch:
    return pa.Table.from_batches([first, second]).combine_chunks().to_batches()[0]


def slices(batch: pa.RecordBatch, rows: int) -> Iterator[pa.RecordBatch]:
    """``batch`` in parts of at most ``rows`` rows."""
    for start in range(0, batch.num_rows, rows):
        yield batch.slice(start, rows)


def frequent_values(rows: DataFrame, least: int) -> list[int]:
    """Values of the one column of ``rows`` that occur ``least`` times or more; for rows of a bounded sample."""
    name = rows.columns[0]
    return [r[0] for r in rows.groupBy(name).count().where(F.col("count") >= least).select(name).collect()]
