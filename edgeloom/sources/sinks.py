"""Writing result pairs as text."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

STYLES = ("delimited", "tuple", "csv")


def format_pairs(df: DataFrame, sep: str = ",", style: str = "delimited") -> DataFrame:
    """``(value)``: one text line per row, ``k<sep>v`` or ``(k,v)``."""
    fields = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in df.columns]
    if style == "tuple":
        return df.select(F.concat(F.lit("("), F.concat_ws(",", *fields), F.lit(")")).alias("value"))
    return df.select(F.concat_ws(sep, *fields).alias("value"))


def _write(rows: DataFrame, path: str, sep: str, style: str, mode: str) -> None:
    if style not in STYLES:
        raise ValueError(f"style must be one of {STYLES}, not {style!r}")
    if style == "csv":
        rows.write.mode(mode).option("sep", sep).csv(path)
    else:
        format_pairs(rows, sep, style).write.mode(mode).text(path)


def write_pairs(df: DataFrame, path: str, sep: str = ",", style: str = "delimited",
                sort_keys: bool = False, mode: str = "errorifexists") -> None:
    """Write each row of ``df`` as a line of text.

    ``style`` is ``delimited`` (``k<sep>v``), ``tuple`` (``(k,v)``) or ``csv`` (fields
    quoted where needed). ``sort_keys`` puts each key into one file and orders every
    file by the key as text.
    """
    if sort_keys:
        key = F.col(df.columns[0])
        df = df.repartition(key).sortWithinPartitions(key.cast("string"))
    _write(df, path, sep, style, mode)


def write_labelled(df: DataFrame, path: str, label: str, sep: str = ",", style: str = "delimited",
                   mode: str = "errorifexists") -> None:
    """Write the row of a result that has one by construction, such as a count, as ``label<sep>value`` in one file."""
    _write(df.select(F.lit(label).alias("label"), *df.columns).coalesce(1), path, sep, style, mode)
