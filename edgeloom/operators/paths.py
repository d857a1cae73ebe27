"""Two-paths as rows, and neighbour lists."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from edgeloom.functions import part_of
from edgeloom.operators.degrees import degrees
from edgeloom.operators.edges import edge_multiplicity
from edgeloom.plans import (
    BROADCAST_ROWS, HUB_ROWS, PATHS_PER_PART, ROWS_PER_PART, STRATEGIES, fits_broadcast, hub_table, split_join,
    with_degree, with_values,
)


def path_grid(folded: DataFrame, paths_per_part: int = PATHS_PER_PART) -> DataFrame:
    """``(v, d, parts_left, parts_right)``: every vertex with the grid that its two-paths form, 1 by 1 for up to ``paths_per_part``.

    Cells are of about that number of paths, and no part is longer than the square root of it, so that
    few rows on one side and very many on the other are split as well.
    """
    side = max(1, int(paths_per_part ** 0.5))
    split = f"CAST(n_in AS double) * n_out > {paths_per_part}"
    return degrees(folded).selectExpr(
        "v", "n_in + n_out AS d", f"IF({split}, ceil(n_in / {side}), 1L) AS parts_left",
        f"IF({split}, ceil(n_out / {side}), 1L) AS parts_right")


def path_hubs(folded: DataFrame, paths_per_part: int = PATHS_PER_PART) -> DataFrame:
    """``(v, parts_left, parts_right)``: the middle vertices that form more than one cell."""
    return path_grid(folded, paths_per_part).where("parts_left * parts_right > 1").drop("d")


def path_sides(edges: DataFrame, paths_per_part: int = PATHS_PER_PART, max_hubs: int = HUB_ROWS) -> tuple[DataFrame, DataFrame]:
    """Both sides of the join at the middle vertex ``y``, each edge with the grid of its ``y``.

    The grids of the largest vertices, bounded by ``hub_table``, are broadcast. Other edges get theirs in a join by their middle
    vertex, which none of them has often, so that every middle vertex is split, however many there are.
    """
    folded = edge_multiplicity(edges)
    at = path_grid(folded, paths_per_part)
    hubs = hub_table(at, folded, 2, 0, max_hubs)
    parts = {"parts_left": "parts_left", "parts_right": "parts_right"}
    return tuple(with_values(folded.selectExpr(*columns), "y", at, hubs, parts) for columns in (
        ("src AS x", "dst AS y", "m AS m_in"), ("src AS y", "dst AS z", "m AS m_out")))


def two_paths(edges: DataFrame, strategy: str = "auto", paths_per_part: int = PATHS_PER_PART,
              broadcast_rows: int = BROADCAST_ROWS, max_hubs: int = HUB_ROWS) -> DataFrame:
    """``(x, y, z, m)``: edges x->y and y->z joined at y, ``m`` times each.

    Copies of an edge are folded first, so a row stands for all copies of a path.
    The result is as large as ``two_path_degree`` says; where only the number is
    wanted, ``two_path_count`` never builds it. The rows of a middle vertex with many paths are laid out as a
    grid of tasks that make about ``paths_per_part`` rows each; ``max_hubs`` bounds what of that is broadcast. Neither changes the result.
    """
    if strategy not in STRATEGIES:
        raise ValueError(f"strategy must be one of {STRATEGIES}, not {strategy!r}")
    folded = edge_multiplicity(edges)
    if strategy == "broadcast" and fits_broadcast(folded, broadcast_rows):
        joined = folded.selectExpr("src AS x", "dst AS y", "m AS m_in").join(
            F.broadcast(folded.selectExpr("src AS y", "dst AS z", "m AS m_out")), "y")
    else:
        into, out = path_sides(edges, paths_per_part, max_hubs)
        joined = split_join(into, out, "y", "x", "z", "merge" if strategy == "shuffle" else None)
    return joined.selectExpr("x", "y", "z", "m_in * m_out AS m")


def adjacency(edges: DataFrame, block_size: int = ROWS_PER_PART, max_hubs: int = HUB_ROWS) -> DataFrame:
    """``(src, block, neighbours, copies)``: whom each vertex points to.

    ``neighbours`` is sorted and free of repeats; ``copies[i]`` says how often the
    edge to ``neighbours[i]`` occurs. A vertex with ``d`` different neighbours has up to ``ceil(d / block_size)`` rows; a
    neighbour falls into one of these blocks by a hash of its id, so blocks hold about, but not exactly,
    ``block_size`` at most. ``max_hubs`` bounds what is broadcast and does not change the result.
    """
    folded = edge_multiplicity(edges)
    out_degree = folded.groupBy(F.col("src").alias("v")).agg(F.count("*").alias("d"))
    hubs = hub_table(out_degree, folded, 1, block_size, max_hubs)
    blocks = with_degree(folded, "src", out_degree, hubs, "d").selectExpr(
        "src", f"{part_of('dst', f'ceil(d / {block_size})')} AS block", "dst", "m")
    return (
        blocks.groupBy("src", "block")
        .agg(F.expr("sort_array(collect_list(struct(dst, m))) AS listed"))
        .selectExpr("src", "block", "listed.dst AS neighbours", "listed.m AS copies")
    )
