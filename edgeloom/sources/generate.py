"""Chain graphs, their vertices and first ranks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SINK = 0


def chain_edges(vertices: DataFrame, k: int, last: int) -> DataFrame:
    """``edges(src, dst)``: chains of ``k`` vertices each, over ``vertices(v)`` = 1..last.

    Vertex ``v`` points to ``v + 1``; the last one of each chain points to the sink 0.
    """
    v = F.col("v")
    end = (v % k == 0) | (v == last)
    return vertices.select(
        v.alias("src"), F.when(end, F.lit(SINK)).otherwise(v + 1).cast("bigint").alias("dst"))


def chain_graph(spark: SparkSession, k: int) -> DataFrame:
    """Edges of ``k`` chains of ``k`` vertices."""
    return chain_edges(numbered_vertices(spark, k), k, k * k)


def chain_vertices(vertices: DataFrame) -> DataFrame:
    """``(v)``: ``vertices(v)`` and the sink 0."""
    return vertices.select(F.col("v").cast("bigint").alias("v")).union(
        vertices.sparkSession.range(1).select(F.lit(SINK).cast("bigint").alias("v")))


def numbered_vertices(spark: SparkSession, k: int) -> DataFrame:
    """``(v)``: the vertices of ``chain_graph`` without the sink."""
    return spark.range(1, k * k + 1).withColumnRenamed("id", "v")


def initial_ranks(vertices: DataFrame, n: int, sink: int | None = SINK) -> DataFrame:
    """``ranks(v, rank)``: ``1/n`` for each vertex, 0 for the sink."""
    share = F.lit(1.0 / n)
    rank = share if sink is None else F.when(F.col("v") == sink, F.lit(0.0)).otherwise(share)
    return vertices.select("v", rank.alias("rank"))
