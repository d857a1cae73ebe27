"""One text file for a result of many rows, written by many tasks."""

from __future__ import annotations

from pyspark.sql import DataFrame

from edgeloom.plans import scratch_path, shuffle_partitions
from edgeloom.sources.sinks import format_pairs


def write_single_file(df: DataFrame, path: str, sep: str = ",", style: str = "delimited", tasks: int | None = None,
                      overwrite: bool = False) -> None:
    """Write the rows of ``df`` as lines of the one file ``path``, in the order of their columns.

    Rows are dealt out in ranges; ``tasks`` tasks (by default as many as a shuffle has) sort and write them below the shared folder, and the
    file system puts the parts together in order: by its own ``concat`` where it has one, else by copying them block by block.
    The file appears under its name when it is complete. ``style`` is ``delimited`` or ``tuple``, as for ``write_pairs``.
    """
    if style not in ("delimited", "tuple"):
        raise ValueError(f"style must be 'delimited' or 'tuple', not {style!r}")
    spark = df.sparkSession
    folder = scratch_path(spark, "single-file")
    dealt = df.repartitionByRange(tasks or shuffle_partitions(spark), *df.columns).sortWithinPartitions(*df.columns)
    format_pairs(dealt, sep, style).write.option("compression", "none").text(folder)
    _join_parts(spark, folder, path, overwrite)


def _join_parts(spark, folder: str, path: str, overwrite: bool) -> None:
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    fs_path = jvm.org.apache.hadoop.fs.Path
    target, source = fs_path(path), fs_path(folder)
    there, here = target.getFileSystem(conf), source.getFileSystem(conf)
    if there.exists(target) and not overwrite:
        raise FileExistsError(path)
    parts = sorted((f.getPath() for f in here.listStatus(source) if f.getPath().getName().startswith("part-") and f.getLen()),
                   key=lambda p: p.getName())
    whole = fs_path(target.getParent(), f"_joining-{source.getName()}")
    if here.getScheme() == "hdfs" and there.getUri() == here.getUri() and parts:
        array = spark.sparkContext._gateway.new_array(fs_path, len(parts) - 1)
        for i, part in enumerate(parts[1:]):
            array[i] = part
        if len(parts) > 1:
            here.concat(parts[0], array)  # moves blocks, copies nothing
        there.mkdirs(target.getParent())
        there.rename(parts[0], whole)
    else:
        out = there.create(whole)
        try:
            for part in parts:
                data = here.open(part)
                try:
                    jvm.org.apache.hadoop.io.IOUtils.copyBytes(data, out, 1 << 20, False)
                finally:
                    data.close()
        finally:
            out.close()
    if overwrite:
        there.delete(target, False)
    if not there.rename(whole, target):
        raise OSError(f"{path} could not be written")
    here.delete(source, True)
