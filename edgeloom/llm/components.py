"""Connected components by alternating large and small stars, each round a written table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from edgeloom.llm.tables import written
from edgeloom.plans import discard


def _stars(links: DataFrame, large: bool) -> DataFrame:
    """Point the larger (or the smaller) neighbours of each node at the smallest one.

    The minimum of a node's neighbours is folded before it is shuffled, and meets the links in a join that
    Spark splits where one node has very many.
    """
    if large:
        links = links.unionByName(links.selectExpr("b AS a", "a AS b"))
    # a is the node, b its neighbour; without ``large`` only smaller neighbours are there
    least = links.groupBy("a").agg(F.min("b").alias("m")).selectExpr("a", "least(a, m) AS m")
    joined = links.join(least.hint("merge"), "a")
    if large:
        return joined.where("b > a AND b != m").selectExpr("b AS a", "m AS b").distinct()
    moved = joined.where("b != m").selectExpr("b AS a", "m AS b")
    return moved.unionByName(least.where("a != m").selectExpr("a", "m AS b")).distinct()


def components(links: DataFrame) -> DataFrame:
    """``(node, component)`` for every node of ``links(a, b)``; the component is its smallest node.

    Links may run in either direction, repeat, or join a node to itself. Rows with a null are left out. Any number of
    links may meet in one node. The driver sees two numbers a round.
    """
    links = links.where("a IS NOT NULL AND b IS NOT NULL")
    nodes = links.selectExpr("a AS node").union(links.selectExpr("b AS node")).distinct()
    current = written(links.where("a != b").selectExpr("greatest(a, b) AS a", "least(a, b) AS b").distinct(), "links")
    before = None
    while True:
        print_of = current.agg(F.count("*"), F.expr("coalesce(bit_xor(xxhash64(a, b)), 0L)")).first()
        if tuple(print_of) == before or not print_of[0]:
            break
        before = tuple(print_of)
        current, last = written(_stars(_stars(current, True), False), "links"), current
        discard(last)
    return nodes.join(current.selectExpr("a AS node", "b AS component").hint("merge"), "node", "left").selectExpr(
        "node", "coalesce(component, node) AS component")
