"""Edge tables: ``edges(src, dst)``, ids NOT NULL, duplicates and self-loops kept."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from edgeloom.functions import ENDPOINTS


def max_filter(edges: DataFrame, n: int) -> DataFrame:
    """Edges with both ids below ``n``; copies of an edge are kept.

    A plain column filter, so it reaches the scan of a columnar source.
    """
    return edges.where((F.col("src") < n) & (F.col("dst") < n))


def reverse_edges(edges: DataFrame) -> DataFrame:
    return edges.select(F.col("dst").alias("src"), F.col("src").alias("dst"))


def edge_multiplicity(edges: DataFrame) -> DataFrame:
    """``(src, dst, m)``: each different edge once, with its number of copies.

    Copies are folded before the shuffle, however many there are. The condition holds
    for every edge; with it, all uses of the table read the same columns under the
    same conditions, also those which only count rows, and so share one shuffle.
    """
    folded = edges.groupBy("src", "dst").agg(F.count("*").alias("m"))
    return folded.where("m > 0 AND src IS NOT NULL AND dst IS NOT NULL")


def vertices_of(edges: DataFrame) -> DataFrame:
    """``(v)``: every id that occurs at either end of an edge."""
    return edges.selectExpr(ENDPOINTS).select("v").distinct()
