"""Finding the few vertices that hold much of a graph, and splitting their rows.

A follow graph may have one user with a third of all edges. Joins on that user
would put those rows into one task, so rows of hubs are spread over several parts
and the matching rows of the other side are repeated once per part. Vertices that
are no hubs have one part and are not repeated.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from edgeloom.functions import part_of

# A hub list never has more rows than this or, for graphs above 10**12 edge ends,
# the square root of their number; either is small enough to broadcast.
HUB_ROWS = 1_000_000

# Rows of one vertex that a single task is happy to take, and joined rows that it is happy to make.
ROWS_PER_PART = 100_000
PATHS_PER_PART = 10_000_000


def hub_table(degrees: DataFrame, edges: DataFrame, ends: int, min_degree: int,
              max_rows: int = HUB_ROWS) -> DataFrame:
    """Vertices of ``degrees(v, d, ...)`` with more than ``part_rows`` rows.

    ``d`` counts rows of ``edges``, each at ``ends`` of its ends, so all degrees
    together are ``ends * count(edges)``. ``part_rows`` is ``min_degree``, raised to that
    sum over ``max_rows`` where the graph is large. Hence fewer than ``max_rows``
    vertices qualify whatever the graph looks like: this bound is what makes the
    result safe to broadcast.
    """
    total = edges.agg((F.count("*") * ends).alias("total")).scalar()
    rows = F.greatest(F.lit(float(max_rows)), F.sqrt(total))
    part_rows = F.greatest(F.lit(min_degree), F.ceil(total / rows)).cast("bigint")
    return degrees.withColumn("part_rows", part_rows).where("d > part_rows")


def with_values(rows: DataFrame, key: str, values: DataFrame, hubs: DataFrame, names: dict[str, str]) -> DataFrame:
    """``rows`` with columns of ``values(v, ...)`` for their ``key``, renamed by ``names``; rows whose key is not there go.

    Values of ``hubs(v, ...)``, of which there are few, are broadcast. The other rows are shuffled by their key, which
    none of them has often.
    """
    own = [f"v AS {key}", *(f"{c} AS {name}" for c, name in names.items())]
    few = F.broadcast(hubs.selectExpr(*own))
    rest = rows.join(F.broadcast(hubs.selectExpr(f"v AS {key}")), key, "left_anti")
    return rows.join(few, key).unionByName(rest.join(values.selectExpr(*own).hint("shuffle_hash"), key))


def with_degree(rows: DataFrame, key: str, degrees: DataFrame, hubs: DataFrame, name: str) -> DataFrame:
    """``rows`` with the degree of ``key`` as column ``name``; rows whose key is not in ``degrees(v, d)`` go."""
    return with_values(rows, key, degrees, hubs, {"d": name})


def split_join(left: DataFrame, right: DataFrame, key: str, left_end: str, right_end: str,
               hint: str | None = None) -> DataFrame:
    """Inner join on ``key`` where a key with many rows forms a grid of tasks instead of one.

    Both sides carry ``parts_left`` and ``parts_right``: in how many parts the rows of their key fall on either side, by
    ``left_end`` and by ``right_end``. Each left part meets each right part in a task of its own. Every
    pair still meets exactly once.
    """
    cell = [key, "left_part", "right_part"]
    left, right = cells(left, "left", left_end, "right"), cells(right, "right", right_end, "left")
    return left.join(right.hint(hint) if hint else right, cell).drop("left_part", "right_part")


def cells(side: DataFrame, own: str, own_end: str, other: str) -> DataFrame:
    """``side`` with the cells of the grid that each row goes to: one part of its own side, every one of the other."""
    return side.selectExpr(
        *(c for c in side.columns if c not in ("parts_left", "parts_right")),
        f"{part_of(own_end, f'parts_{own}')} AS {own}_part",
        f"explode(sequence(0L, parts_{other} - 1)) AS {other}_part",
    )
