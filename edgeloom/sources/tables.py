"""Edges out of columnar tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def edges_from(table: DataFrame, src: str | Column, dst: str | Column, id_type: str = "bigint") -> DataFrame:
    """``edges(src, dst)`` of two columns; rows without both ids are no edges."""
    src, dst = (F.col(c) if isinstance(c, str) else c for c in (src, dst))
    edges = table.select(src.cast(id_type).alias("src"), dst.cast(id_type).alias("dst"))
    return edges.where(F.col("src").isNotNull() & F.col("dst").isNotNull())


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _users(spark: SparkSession, sf_dir: str, name: str) -> Column:
    """The number of rows of a table, as part of the plan that uses it."""
    return table(spark, sf_dir, name).agg(F.count("*")).scalar()


def follows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sparse follow graph over customers: one edge per order."""
    return edges_from(table(spark, sf_dir, "orders"), "o_custkey", F.col("o_orderkey") % _users(spark, sf_dir, "customer"))


def follows_dense(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dense multigraph over suppliers: one edge per line item, many copies and loops."""
    return edges_from(table(spark, sf_dir, "lineitem"), "l_suppkey", F.col("l_partkey") % _users(spark, sf_dir, "supplier"))


def follows_skewed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Follow graph over customers in which a few users have most followers: one edge per order.

    The rank of the followed user grows with the cube of a number below 1000.
    """
    orders = table(spark, sf_dir, "orders").withColumn("users", _users(spark, sf_dir, "customer"))
    return edges_from(orders.selectExpr(
        "o_custkey AS src", "((o_orderkey % 1000) * (o_orderkey % 1000) * (o_orderkey % 1000) * users) div 1000000000 AS dst"),
        "src", "dst")
