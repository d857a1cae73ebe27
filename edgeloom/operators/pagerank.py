"""Iterative rank over a follow graph.

One step passes the rank of every vertex along its out-edges (each copy of an edge
carries it again), then spreads the rank that arrived at the sink evenly over the
other vertices and empties the sink. There is no damping. With
``normalize="none"`` a vertex hands its whole rank to each out-edge, which keeps the
total only where every vertex has one out-edge; ``normalize="out_degree"`` divides it
among the out-edges and spreads the rank of vertices without out-edges as well.
"""

from __future__ import annotations

import hashlib

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from edgeloom.functions import part_of
from edgeloom.operators.edges import edge_multiplicity
from edgeloom.plans import ROWS_PER_PART, Ledger, discard, hub_table, shuffle_partitions, stage

NORMALIZE = ("none", "out_degree")


def _split_links(edges: DataFrame, rows_per_part: int) -> DataFrame:
    """``(src, part, parts, dst, m)``: every different edge once, ready to meet ranks.

    The out-edges of a hub are spread over ``parts`` parts; other vertices have one.
    """
    folded = edge_multiplicity(edges)
    out = folded.groupBy(F.col("src").alias("v")).agg(F.count("*").alias("d"))
    hubs = hub_table(out, folded, 1, rows_per_part).selectExpr("v AS src", "ceil(d / part_rows) AS hub_parts")
    parts = "coalesce(hub_parts, 1L)"
    return folded.join(F.broadcast(hubs), "src", "left").selectExpr(
        "src", f"{part_of('dst', parts)} AS part", f"{parts} AS parts", "dst", "m")


def _sources(links: DataFrame) -> DataFrame:
    """``(v, out_degree, parts)``: who has out-edges, and how many parts need its rank."""
    return links.groupBy(F.col("src").alias("v")).agg(
        F.sum("m").alias("out_degree"), F.max("parts").alias("parts"))


def _incoming(links: DataFrame, ranks: DataFrame, normalize: str) -> DataFrame:
    """``(dst, inc)``: rank that arrives, for ``ranks(v, rank, out_degree, parts)``.

    Sums are made partially before the shuffle on ``dst``, so popular users cost one
    row per task.
    """
    share = "rank / out_degree" if normalize == "out_degree" else "rank"
    sent = ranks.where("out_degree > 0").selectExpr(
        "v AS src", f"{share} AS share", "explode(sequence(0L, parts - 1)) AS part")
    return links.select("src", "part", "dst", "m").join(sent, ["src", "part"]).groupBy("dst").agg(F.expr("sum(m * share) AS inc"))


def _is_sink(vertex: Column, sink) -> Column:
    return F.lit(False) if sink is None else vertex == F.lit(sink)


def _dead_end(sink) -> Column:
    """The vertex passes nothing on, although it is not the sink."""
    return (F.col("out_degree") == 0) & ~_is_sink(F.col("v"), sink)


def _sum_where(df: DataFrame, condition: Column, column: str) -> DataFrame:
    """One row: the sum of ``column`` over the rows that meet ``condition``, or 0.

    The condition is kept inside of the sum. As a filter it would travel down to the
    edges, and Spark would fold and join them a second time for the few that meet it.
    """
    chosen = F.when(condition, F.col(column)).otherwise(F.lit(0.0))
    return df.agg(F.coalesce(F.sum(chosen), F.lit(0.0)).alias("total"))


def _new_rank(sink, spread) -> Column:
    return F.when(_is_sink(F.col("v"), sink), F.lit(0.0)).otherwise(F.col("inc") + spread).alias("rank")


def _checked(normalize: str) -> None:
    if normalize not in NORMALIZE:
        raise ValueError(f"normalize must be one of {NORMALIZE}, not {normalize!r}")


def incoming_rank(edges: DataFrame, ranks: DataFrame, normalize: str = "none",
                  rows_per_part: int = ROWS_PER_PART) -> DataFrame:
    """``(v, inc)``: sum of the ranks passed along the in-edges of each vertex."""
    _checked(normalize)
    links = _split_links(edges, rows_per_part)
    inc = _incoming(links, ranks.join(_sources(links), "v"), normalize)
    return inc.select(F.col("dst").alias("v"), "inc")


def pagerank_step(edges: DataFrame, vertices: DataFrame, ranks: DataFrame, n: int, sink=None,
                  normalize: str = "none", rows_per_part: int = ROWS_PER_PART) -> DataFrame:
    """``(v, rank)`` after one step from ``ranks(v, rank)``; ``n`` vertices share the spread.

    Every vertex of ``vertices`` stays, also without in-edges. Edges from vertices
    without a rank carry nothing. The spread is 0 if nothing reached the sink.
    """
    _checked(normalize)
    links = _split_links(edges, rows_per_part)
    known = ranks.join(_sources(links), "v", "left").withColumn("out_degree", F.coalesce("out_degree", F.lit(0)))
    inc = _incoming(links, known, normalize)

    spread = F.lit(0.0)
    if sink is not None:
        spread = spread + _sum_where(inc, _is_sink(F.col("dst"), sink), "inc").scalar()
    if normalize == "out_degree":
        spread = spread + _sum_where(known, _dead_end(sink), "rank").scalar()

    kept = vertices.select("v").join(inc.withColumnRenamed("dst", "v"), "v", "left")
    return kept.select("v", F.coalesce("inc", F.lit(0.0)).alias("inc")).select(
        "v", _new_rank(sink, spread / F.lit(n)))


def pagerank(edges: DataFrame, vertices: DataFrame, iterations: int, sink=None, n: int | None = None,
             normalize: str = "none", ranks: DataFrame | None = None,
             rows_per_part: int = ROWS_PER_PART, resume: str | None = None) -> DataFrame:
    """``(v, rank)`` after ``iterations`` steps; the sink is always a row with 0.

    ``ranks`` defaults to ``1/n`` for each vertex and 0 for the sink; ``n`` to the
    number of vertices besides the sink. Given ranks of ids outside of the vertices pass
    theirs on in the first step, as in ``pagerank_step``. Links and vertices are laid out and kept
    once, so a step shuffles the ranks and the partial sums but never the links. Each
    step is one job that ends in a written table (see ``stage``) and deletes that of the step before: no
    lineage builds up, and a lost executor costs its share of the links and of the step under way. Per step the
    driver sees three numbers, which the job that writes has observed.

    ``resume`` names a folder that outlives the driver. Steps are kept there, each entered in a ledger once it is written as
    a whole, and a later call goes on from the last one entered, up to ``iterations``; the result is that of an unbroken run. The ledger
    belongs to one graph and one set of parameters, and another one is an error. The last two steps entered remain in the folder.
    """
    _checked(normalize)
    spark = edges.sparkSession
    tasks = shuffle_partitions(spark)

    links = _split_links(edges, rows_per_part).repartition(tasks, "src", "part").persist(
        StorageLevel.MEMORY_AND_DISK)
    vertices = vertices.select("v")
    if sink is not None:
        id_type = vertices.schema["v"].dataType
        vertices = vertices.union(spark.range(1).select(F.lit(sink).cast(id_type).alias("v")))
    vertices = _with_links(vertices.distinct(), links).repartition(tasks, "v").persist(StorageLevel.MEMORY_AND_DISK)
    try:
        if n is None:
            n = vertices.where(~_is_sink(F.col("v"), sink)).count()
        if ranks is None:
            start = F.when(_is_sink(F.col("v"), sink), F.lit(0.0)).otherwise(F.lit(1.0 / max(n, 1)))
            current = vertices.withColumn("rank", start)
        elif iterations:
            current = _with_links(ranks.select("v", "rank"), links)
        else:
            current = vertices.join(ranks.select("v", "rank"), "v", "left").withColumn(
                "rank", F.coalesce("rank", F.lit(0.0)))
        if iterations == 0:
            return stage(current, "ranks").select("v", "rank")

        ledger, done = None, None
        if resume is not None:
            ledger = Ledger(spark, resume, _fingerprint(links, vertices, current, sink, n, normalize))
            done = ledger.last(iterations)
        held, first = 0.0, 0  # rank of dead ends before the step; steps that are there
        if done is not None:
            arrived = spark.read.schema(_arrived_schema(current)).parquet(done.path)
            current, held, first = _after(arrived, sink, done.spread), done.held, done.step
        elif normalize == "out_degree":
            held = _sum_where(current, _dead_end(sink), "rank").first()["total"]
        before = None
        for step in range(first + 1, iterations + 1):
            inc = _incoming(links, current, normalize).withColumnRenamed("dst", "v")
            arrived, seen = vertices.join(inc, "v", "left").withColumn("inc", F.coalesce("inc", F.lit(0.0))), Observation()
            zero = F.lit(0.0)
            arrived = arrived.observe(
                seen,
                F.sum(F.when(_is_sink(F.col("v"), sink), F.col("inc")).otherwise(zero)).alias("sink"),
                F.sum(F.when(_dead_end(sink), F.col("inc")).otherwise(zero)).alias("dead"),
                F.sum(F.when(_dead_end(sink), F.lit(1)).otherwise(F.lit(0))).alias("dead_ends"),
            )
            arrived = stage(arrived, "ranks") if ledger is None else ledger.write(arrived, step)
            sums = {name: value or 0 for name, value in seen.get.items()}
            total = sums["sink"] + (held if normalize == "out_degree" else 0.0)
            spread = total / n if n else 0.0
            held = sums["dead"] + sums["dead_ends"] * spread
            current = _after(arrived, sink, spread)
            if ledger is not None:
                ledger.enter(step, spread, held)
            elif before is not None:
                discard(before)
            before = arrived
        return current.select("v", "rank")
    finally:
        links.unpersist()
        vertices.unpersist()


def _after(arrived: DataFrame, sink, spread: float) -> DataFrame:
    return arrived.select("v", "out_degree", "parts", _new_rank(sink, F.lit(spread)))


def _arrived_schema(current: DataFrame) -> StructType:
    kinds = {f.name: f.dataType for f in current.schema}
    return StructType([StructField("v", kinds["v"]), StructField("out_degree", kinds["out_degree"]),
                       StructField("parts", kinds["parts"]), StructField("inc", DoubleType())])


def _fingerprint(links: DataFrame, vertices: DataFrame, start: DataFrame, sink, n: int, normalize: str) -> str:
    """A digest of the graph, the start ranks and the parameters; it does not depend on the order of rows."""
    total = "CAST(coalesce(sum(CAST(xxhash64({}) AS decimal(38, 0))), 0) AS string) AS total"
    sums = [df.selectExpr(total.format(columns)).first()["total"] for df, columns in (
        (links, "src, dst, m"), (vertices, "v"), (start, "v, rank"))]
    return hashlib.sha256(repr((*sums, sink, n, normalize)).encode()).hexdigest()


def _with_links(known: DataFrame, links: DataFrame) -> DataFrame:
    """``known`` with ``out_degree`` and ``parts``, 0 and 1 for ids without out-edges."""
    return known.join(_sources(links), "v", "left").withColumns({
        "out_degree": F.coalesce("out_degree", F.lit(0)),
        "parts": F.coalesce("parts", F.lit(1)).cast("bigint"),
    })
