"""Counting followers, degrees and two-paths without building any path."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from edgeloom.functions import ENDPOINTS, total_or_error


def follower_count(edges: DataFrame) -> DataFrame:
    """``(user, followers)``: edges that point to each user, copies included.

    Users without followers have no row. Partial counts are made before the
    shuffle, so a user with a third of all edges costs one row per map task.
    """
    return edges.groupBy(F.col("dst").alias("user")).agg(F.count("*").alias("followers"))


def degrees(edges: DataFrame) -> DataFrame:
    """``(v, n_out, n_in)`` for every id at either end of an edge, in one scan."""
    return (
        edges.selectExpr(ENDPOINTS)
        .groupBy("v")
        .agg(F.sum("n_out").alias("n_out"), F.sum("n_in").alias("n_in"))
    )


def two_path_degree(edges: DataFrame, count_type: str = "bigint") -> DataFrame:
    """``(v, paths)``: two-paths with ``v`` in the middle, 0 where one side is empty.

    A count beyond ``count_type`` is an error.
    """
    return _paths(edges, count_type).selectExpr(
        "v", f"coalesce(paths, CAST(raise_error('ARITHMETIC_OVERFLOW: the count is beyond {count_type}') AS {count_type})) AS paths")


def _paths(edges: DataFrame, count_type: str) -> DataFrame:
    return degrees(edges).selectExpr("v", f"try_cast(try_multiply(CAST(n_out AS {count_type}), n_in) AS {count_type}) AS paths")


def two_path_count(edges: DataFrame, count_type: str = "bigint") -> DataFrame:
    """One row ``(paths)``: how many two-paths the multigraph has.

    Takes the sum of out-degree times in-degree, one row per vertex, where the
    paths themselves may be far more than the edges. A count beyond 64 bits is an
    error, whatever the session's settings; ``count_type="decimal(38,0)"`` makes room for it.
    """
    return _paths(edges, count_type).agg(F.expr(f"{total_or_error('paths', count_type)} AS paths"))
