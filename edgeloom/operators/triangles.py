"""Directed triangles x->y->z->x: the rows and the count.

Edges are folded to pairs of neighbours once; every later step reads that one
shuffle again. Triangles come from two-paths whose middle vertex has the lowest rank
of the three, where vertices are ranked by degree. A hub ranks high, so it is hardly
ever in the middle: a vertex has at most about sqrt(2 * edges) neighbours above it. The paths
of a middle vertex that has many of them are laid out as a grid of tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from edgeloom.functions import closed_paths, part_of, safe_sum, total_or_error
from edgeloom.operators.lists import BLOCK_ENTRIES, WHOLE, closed_by_lists, cycles_by_lists, dealt_lists
from edgeloom.plans import (
    BROADCAST_ROWS, HUB_ROWS, ROWS_PER_PART, STRATEGIES, fits_broadcast, hub_table, shuffle_partitions, stage, with_degree,
)

# Neighbours of a middle vertex in one part: a cell of the grid makes about the square of it in paths.
MIDDLE_ROWS = 3_000

# Neighbours of a vertex, on average, from which on `triangles` probes lists: it has far more two-paths than pairs.
DENSE_DEGREE = 100

MULTIPLICITIES = ("distinct", "all", "closing_exists")


def pair_multiplicity(edges: DataFrame, distinct: bool = False, count_type: str = "bigint") -> DataFrame:
    """``(a, b, m_ab, m_ba)`` with ``a <= b``: copies of a->b and of b->a.

    A self-loop is the pair ``a = b`` with its copies in ``m_ab``. With ``distinct``
    both counts are 0 or 1 and loops are left out.
    """
    return _folded_pairs(edges, distinct, count_type).selectExpr(
        "a", "b", "m_ab", f"CAST(coalesce(m_ba, 0) AS {count_type}) AS m_ba")


def _folded_pairs(edges: DataFrame, distinct: bool, count_type: str) -> DataFrame:
    """As ``pair_multiplicity``, with ``m_ba`` null for a loop, which has no way back.

    Loops are told apart by that sum and not by their ids: a condition on the ids would
    travel below the shuffle, and the uses with and without loops could not share it.
    For the same reason the condition at the end names all columns, as in
    ``edge_multiplicity``.
    """
    if distinct:
        edges = edges.where("src != dst")
    fold = "max" if distinct else "sum"
    return (
        edges.selectExpr("least(src, dst) AS a", "greatest(src, dst) AS b", "src <= dst AS up",
                         "CASE WHEN src > dst THEN 1L WHEN src < dst THEN 0L END AS down")
        .groupBy("a", "b")
        .agg(F.expr(f"CAST({fold}(IF(up, 1L, 0L)) AS {count_type}) AS m_ab"),
             F.expr(f"CAST({fold}(down) AS {count_type}) AS m_ba"))
        .where("m_ab + coalesce(m_ba, 0) > 0 AND a IS NOT NULL AND b IS NOT NULL")
    )


class _Joins:
    """How the joins of one triangle run are to be done."""

    def __init__(self, pairs: DataFrame, strategy: str, broadcast_rows: int, middle_rows: int, max_hubs: int):
        """``pairs`` are the folded pairs that the joins use; counting them is a scan of its own."""
        if strategy not in STRATEGIES:
            raise ValueError(f"strategy must be one of {STRATEGIES}, not {strategy!r}")
        self.replicate = strategy == "broadcast" and fits_broadcast(pairs, broadcast_rows)
        self.hint = "merge" if strategy == "shuffle" else None
        self.tasks = shuffle_partitions(pairs.sparkSession)
        self.middle_rows, self.max_hubs = middle_rows, max_hubs

    def side(self, df: DataFrame) -> DataFrame:
        if self.replicate:
            return F.broadcast(df)
        return df.hint(self.hint) if self.hint else df

    def low_middle_paths(self, ranked: DataFrame) -> DataFrame:
        """``(x, y, z, m_in, m_out, d_x, d_z)``: two-paths over three vertices, lowest rank at y."""
        # Ties go by id: a < b. Of d_low neighbours at most ``reach`` rank higher.
        ordered = ranked.withColumn("a_low", F.expr("d_a <= d_b")).selectExpr(
            "IF(a_low, a, b) AS low", "IF(a_low, b, a) AS high", "IF(a_low, d_b, d_a) AS d_high",
            "IF(a_low, m_ab, m_ba) AS m_up", "IF(a_low, m_ba, m_ab) AS m_down",
            f"greatest(1L, ceil(least(IF(a_low, d_a, d_b), reach) / {self.middle_rows})) AS parts")
        each = "explode(sequence(0L, parts - 1))"
        into = ordered.where("m_down > 0").selectExpr(
            "high AS x", "low AS y", "m_down AS m_in", "d_high AS d_x", "parts", f"{part_of('high', 'parts')} AS into_part")
        out = ordered.where("m_up > 0").selectExpr(
            "low AS y", "high AS z", "m_up AS m_out", "d_high AS d_z", "parts", f"{part_of('high', 'parts')} AS out_part")
        if self.replicate:
            return into.drop("parts", "into_part").repartition(self.tasks, "x", "y").join(
                F.broadcast(out.drop("parts", "out_part")), "y").where("x != z")
        # A few bytes of edges make many paths, so the number of tasks is fixed here
        # instead of being merged by the size of their input.
        cell = ["y", "into_part", "out_part"]
        into = into.selectExpr("x", "y", "m_in", "d_x", "into_part", f"{each} AS out_part").repartition(self.tasks, *cell)
        out = out.selectExpr("y", "z", "m_out", "d_z", "out_part", f"{each} AS into_part").repartition(self.tasks, *cell)
        return into.join(self.side(out), cell).drop("into_part", "out_part").where("x != z")


def _ranked(pairs: DataFrame, max_hubs: int = HUB_ROWS) -> DataFrame:
    """``pairs`` without loops, with the degrees ``d_a`` and ``d_b`` that rank their ends, and ``reach``.

    ``reach`` bounds how many neighbours of a vertex rank above it: were there more than sqrt(2 * pairs), their
    degrees alone would exceed the sum of all. Every vertex has its exact degree; ``max_hubs`` only says of how many it is
    broadcast.
    """
    degree = pairs.selectExpr("explode(array(a, b)) AS v").groupBy("v").agg(F.count("*").alias("d"))
    hubs = hub_table(degree, pairs, 2, 0, max_hubs)
    reach = pairs.agg(F.ceil(F.sqrt(F.count("*") * 2)).alias("reach")).scalar()
    ranked = with_degree(with_degree(pairs, "a", degree, hubs, "d_a"), "b", degree, hubs, "d_b")
    return ranked.select("a", "b", "m_ab", "m_ba", "d_a", "d_b", reach.alias("reach"))


def _cycle_sums(pairs: DataFrame, multiplicity: str, joins: _Joins) -> DataFrame:
    """``(closed)``: closed two-paths over three different vertices, in partial sums."""
    # The closing edge z->x is a->b of its pair where z < x, and b->a otherwise.
    product, both = "try_multiply(m_in, m_out)", "try_add(m_in, m_out)"
    paths = joins.low_middle_paths(_ranked(pairs, joins.max_hubs)).selectExpr(
        "least(x, z) AS a", "greatest(x, z) AS b",
        f"IF(z < x, {product}, 0) AS products_ab", f"IF(z < x, {both}, 0) AS sums_ab",
        f"IF(z < x, 0, {product}) AS products_ba", f"IF(z < x, 0, {both}) AS sums_ba")
    if not joins.replicate:
        # One row per pair of ends goes through the shuffle instead of every path,
        # and arrives where the folded pair already is.
        paths = paths.groupBy("a", "b").agg(
            *[F.expr(f"{safe_sum(c)} AS {c}") for c in paths.columns if c not in ("a", "b")])
    ab = closed_paths(multiplicity, "products_ab", "sums_ab", "m_ab")
    ba = closed_paths(multiplicity, "products_ba", "sums_ba", "m_ba")
    return paths.join(joins.side(pairs), ["a", "b"]).selectExpr(
        f"try_add(IF(m_ab > 0, {ab}, 0), IF(m_ba > 0, {ba}, 0)) AS closed")


def _loop_sums(loops: DataFrame, pairs: DataFrame, multiplicity: str) -> DataFrame:
    """``(closed)``: closed two-paths that use a self-loop.

    They stay on one vertex, or run over a vertex v with a loop and a neighbour in
    both directions. Per v only sums over such neighbours matter, so the join has one
    row per vertex on either side.
    """
    there_and_back = (
        pairs.where("m_ab > 0 AND m_ba > 0")
        .selectExpr("explode(array(a, b)) AS v", "m_ab", "m_ba")
        .groupBy("v")
        .agg(F.expr(f"{safe_sum('try_multiply(m_ab, m_ba)')} AS products"), F.expr(f"{safe_sum('try_add(m_ab, m_ba)')} AS sums"),
             F.lit(True).alias("some"))
    )
    alone = "try_multiply(loop, loop)" if multiplicity != "all" else "try_multiply(try_multiply(loop, loop), loop)"
    shared = closed_paths(multiplicity, "products", "sums", "loop")
    return loops.join(there_and_back, "v", "left").selectExpr(
        f"try_add({alone}, IF(some IS NULL, 0, {shared})) AS closed")


def _closed(edges, multiplicity, strategy, count_type, broadcast_rows, middle_rows, max_hubs, block_entries) -> DataFrame:
    """``(closed)`` in partial sums, null where one is beyond ``count_type``."""
    if multiplicity not in MULTIPLICITIES:
        raise ValueError(f"multiplicity must be one of {MULTIPLICITIES}, not {multiplicity!r}")
    folded = _folded_pairs(edges, multiplicity == "distinct", count_type)
    if strategy == "lists":
        folded, entries = _staged(folded)
    pairs = folded if multiplicity == "distinct" else folded.where("m_ba IS NOT NULL")
    if strategy == "lists":
        sums = closed_by_lists(dealt_lists(_ranked(pairs, max_hubs), entries, block_entries), multiplicity, count_type)
    else:
        sums = _cycle_sums(pairs, multiplicity, _Joins(pairs, strategy, broadcast_rows, middle_rows, max_hubs))
    if multiplicity == "distinct":
        return sums
    loops = folded.where("m_ba IS NULL").selectExpr("a AS v", "m_ab AS loop")
    return sums.unionByName(_loop_sums(loops, pairs, multiplicity))


def _staged(folded: DataFrame) -> tuple[DataFrame, int]:
    """``folded`` pairs, written once, and how many of them are no loops."""
    seen = Observation()
    folded = stage(folded.observe(seen, F.count("m_ba").alias("entries")), "pairs")
    return folded, seen.get["entries"] or 0


def _is_dense(edges: DataFrame) -> bool:
    """Whether vertices have ``DENSE_DEGREE`` neighbours on average, about; one scan, no shuffle of edges."""
    if any(edges.schema[c].dataType.simpleString() not in WHOLE for c in ("src", "dst")):
        return False
    seen = edges.where("src != dst").selectExpr(
        "approx_count_distinct(struct(least(src, dst), greatest(src, dst))) AS pairs",
        "greatest(approx_count_distinct(src), approx_count_distinct(dst)) AS vertices").first()
    return 2 * seen.pairs > DENSE_DEGREE * seen.vertices


def closed_two_path_count(edges: DataFrame, multiplicity: str = "distinct", strategy: str = "auto",
                          count_type: str = "bigint", broadcast_rows: int = BROADCAST_ROWS,
                          middle_rows: int = MIDDLE_ROWS, max_hubs: int = HUB_ROWS,
                          block_entries: int = BLOCK_ENTRIES) -> DataFrame:
    """One row ``(closed)``: two-paths x->y->z for which z->x exists.

    ``multiplicity`` says what copies of an edge and self-loops do:

    * ``distinct``: neither counts, so three closed paths are one directed 3-cycle;
    * ``all``: each copy of all three edges counts, loops are edges like others;
    * ``closing_exists``: copies count on the path, the closing edge counts once.

    ``strategy`` is ``shuffle`` (sort-merge joins), ``broadcast`` (the graph goes to
    every executor, if it has at most ``broadcast_rows`` different pairs; otherwise as
    ``auto``; edges are then scanned twice), ``lists`` (neighbour lists are probed for each edge and no path becomes a row, which pays
    where vertices have many neighbours in common; ids must be whole numbers), or ``auto`` (the planner decides). A count beyond
    ``count_type`` is an error, whatever the session's settings. ``middle_rows``, ``max_hubs`` and ``block_entries`` lay out tasks and do not
    change the count.
    """
    closed = _closed(edges, multiplicity, strategy, count_type, broadcast_rows, middle_rows, max_hubs, block_entries)
    return closed.agg(F.expr(f"{total_or_error('closed', count_type)} AS closed"))


def triangle_count(edges: DataFrame, multiplicity: str = "distinct", strategy: str = "auto",
                   count_type: str = "bigint", broadcast_rows: int = BROADCAST_ROWS,
                   middle_rows: int = MIDDLE_ROWS, max_hubs: int = HUB_ROWS, block_entries: int = BLOCK_ENTRIES) -> DataFrame:
    """One row ``(triangles)``: a third of the closed two-paths, rounded down.

    Always one row, 0 for a graph without triangles. Parameters as for
    ``closed_two_path_count``.
    """
    closed = closed_two_path_count(
        edges, multiplicity, strategy, count_type, broadcast_rows, middle_rows, max_hubs, block_entries)
    # div would be shorter, but its result is always 64 bits wide
    return closed.selectExpr(f"CAST((closed - closed % 3) / 3 AS {count_type}) AS triangles"
                             if count_type != "bigint" else "closed div 3 AS triangles")


def triangles(edges: DataFrame, strategy: str = "auto", broadcast_rows: int = BROADCAST_ROWS,
              rows_per_part: int = ROWS_PER_PART, middle_rows: int = MIDDLE_ROWS, max_hubs: int = HUB_ROWS,
              block_entries: int = BLOCK_ENTRIES) -> DataFrame:
    """``(x, y, z)``: each directed 3-cycle once, beginning at its smallest id.

    ``auto`` probes neighbour lists, as ``lists`` does, where vertices have very many neighbours (``DENSE_DEGREE`` on average)
    and ids are whole numbers: joins would shuffle every two-path.

    Two hubs may be the ends of very many two-paths, though never of more than the
    smaller of their degrees. The paths of such a pair are spread over parts by their
    middle vertex, and the pair is repeated for each part.
    """
    pairs = _folded_pairs(edges, True, "bigint")
    if strategy == "lists" or strategy == "auto" and _is_dense(edges):
        staged, entries = _staged(pairs)
        found = cycles_by_lists(dealt_lists(_ranked(staged, max_hubs), entries, block_entries))
        id_type = pairs.schema["a"].dataType.simpleString()
        return _from_smallest(found).selectExpr(*(f"CAST({c} AS {id_type}) AS {c}" for c in "xyz"))
    joins = _Joins(pairs, strategy, broadcast_rows, middle_rows, max_hubs)
    ranked = _ranked(pairs, max_hubs)
    paths = joins.low_middle_paths(ranked).withColumn("parts", _parts("d_x", "d_z", rows_per_part)).selectExpr(
        "x", "y", "z", "least(x, z) AS a", "greatest(x, z) AS b", f"{part_of('y', 'parts')} AS part")
    closing = ranked.withColumn("parts", _parts("d_a", "d_b", rows_per_part)).selectExpr(
        "a", "b", "m_ab", "m_ba", "explode(sequence(0L, parts - 1)) AS part")
    cycles = paths.join(joins.side(closing), ["a", "b", "part"]).where("IF(z < x, m_ab, m_ba) > 0")
    return _from_smallest(cycles)


def _from_smallest(cycles: DataFrame) -> DataFrame:
    return cycles.withColumn("first", F.expr("least(x, y, z)")).selectExpr(
        "first AS x",
        "CASE first WHEN x THEN y WHEN y THEN z ELSE x END AS y",
        "CASE first WHEN x THEN z WHEN y THEN x ELSE y END AS z",
    )


def _parts(degree: str, other_degree: str, rows_per_part: int) -> Column:
    return F.expr(f"greatest(1L, ceil(least({degree}, {other_degree}) / {rows_per_part}))")
