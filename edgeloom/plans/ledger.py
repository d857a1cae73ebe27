"""Finished steps of an iteration, kept so that another driver can go on from them."""

from __future__ import annotations

from pyspark.sql import DataFrame, Row, SparkSession


class Ledger:
    """Tables of steps below ``folder`` and a ledger that says which of them are whole.

    A step is written to a folder of its own first. Its entry, one row of JSON, is appended afterwards; Spark's
    committer shows the row as a whole or not at all, so a step that is entered can be read. What a lost driver has left of an
    unfinished step is overwritten. ``fingerprint`` says what the steps belong to.
    """

    SCHEMA = "step BIGINT, spread DOUBLE, held DOUBLE, path STRING, fingerprint STRING"

    def __init__(self, spark: SparkSession, folder: str, fingerprint: str):
        self.spark, self.folder, self.fingerprint = spark, folder.rstrip("/"), fingerprint

    def _step(self, step: int) -> str:
        return f"{self.folder}/step-{step:06d}"

    def _file_system(self, path: str):
        context = self.spark.sparkContext
        at = context._jvm.org.apache.hadoop.fs.Path(path)
        return at.getFileSystem(context._jsc.hadoopConfiguration()), at

    def last(self, most: int) -> Row | None:
        """The entry of the latest step up to ``most`` whose table is still there."""
        files, at = self._file_system(f"{self.folder}/ledger")
        if not files.exists(at):
            return None
        entries = self.spark.read.schema(self.SCHEMA).json(f"{self.folder}/ledger").collect()  # a row for each step
        if any(e.fingerprint != self.fingerprint for e in entries):
            raise ValueError(f"{self.folder} holds steps of another graph or of other parameters")
        for entry in sorted(entries, key=lambda e: -e.step):
            if entry.step <= most and files.exists(self._file_system(entry.path)[1]):
                return entry
        return None

    def write(self, df: DataFrame, step: int) -> DataFrame:
        df.write.mode("overwrite").parquet(self._step(step))
        return self.spark.read.schema(df.schema).parquet(self._step(step))

    def enter(self, step: int, spread: float, held: float) -> None:
        """Say that ``step`` is whole, and delete the one before its predecessor."""
        row = (step, spread, held, self._step(step), self.fingerprint)
        self.spark.createDataFrame([row], self.SCHEMA).coalesce(1).write.mode("append").json(f"{self.folder}/ledger")
        files, at = self._file_system(self._step(step - 2))
        files.delete(at, True)
