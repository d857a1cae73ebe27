import importlib
import random
from pathlib import Path

import pytest
from pyspark.sql import functions as F

import brute
from edgeloom.plans import stage
from edgeloom import (
    chain_graph, chain_vertices, incoming_rank, initial_ranks, numbered_vertices, pagerank, pagerank_step,
)

# Ranks of the chain graph with k = 100 after 10 iterations, by position in a chain.
# Fixed values.
GOLDEN = [
    1.0936852726843606e-06, 2.1765419783124407e-06, 3.248677330419451e-06, 4.310197481020451e-06,
    5.3612075311204505e-06, 6.401811541120451e-06, 7.4321125411204515e-06, 8.452212541120452e-06,
    9.462212541120453e-06, 1.0462212541120453e-05,
]
GOLDEN_REST = 1.1046221254112046e-04


def ranks_of(df):
    rows = df.select("v", "rank").collect()
    found = {r.v: r.rank for r in rows}
    assert len(found) == len(rows)
    return found


def test_chain_of_100_by_100(spark):
    ranks = ranks_of(pagerank(chain_graph(spark, 100), chain_vertices(numbered_vertices(spark, 100)), 10, sink=0))
    assert len(ranks) == 10_001
    assert ranks.pop(0) == 0.0
    for v, rank in ranks.items():
        position = (v - 1) % 100
        want = GOLDEN[position] if position < 10 else GOLDEN_REST
        assert rank == pytest.approx(want, rel=1e-12)
    assert sum(ranks.values()) == pytest.approx(1.0, rel=1e-12)


def test_chain_parts(spark):
    assert sorted(map(tuple, chain_graph(spark, 2).collect())) == [(1, 2), (2, 0), (3, 4), (4, 0)]
    assert sorted(r.v for r in chain_vertices(numbered_vertices(spark, 2)).collect()) == [0, 1, 2, 3, 4]
    assert sorted(r.v for r in numbered_vertices(spark, 2).collect()) == [1, 2, 3, 4]
    ranks = ranks_of(initial_ranks(chain_vertices(numbered_vertices(spark, 2)), 4))
    assert ranks == {0: 0.0, 1: 0.25, 2: 0.25, 3: 0.25, 4: 0.25}


@pytest.mark.parametrize("normalize", ["none", "out_degree"])
@pytest.mark.parametrize("sink", [0, None])
def test_random_graphs(spark, edges, normalize, sink):
    rng = random.Random(f"{normalize}{sink}")
    pairs = [(rng.randrange(8), rng.randrange(10)) for _ in range(30)] + [(3, v) for v in range(9)] * 2
    graph = edges(pairs)
    vertices = spark.range(10).withColumnRenamed("id", "v")
    n = 9 if sink == 0 else 10
    want = brute.pagerank(pairs, range(10), 3, sink, n, normalize)
    # rows_per_part=2 makes hubs of most vertices
    for rows_per_part in (2, 100_000):
        got = ranks_of(pagerank(graph, vertices, 3, sink=sink, normalize=normalize, rows_per_part=rows_per_part))
        assert got == pytest.approx(want, rel=1e-12)
    if normalize == "out_degree":
        assert sum(got.values()) == pytest.approx(1.0, rel=1e-12)

    step = initial_ranks(vertices, n, sink)
    for _ in range(2):
        step = pagerank_step(graph, vertices, step, n, sink, normalize, rows_per_part=3)
    assert ranks_of(step) == pytest.approx(brute.pagerank(pairs, range(10), 2, sink, n, normalize), rel=1e-12)


def test_edges_outside_of_the_vertices(spark, edges):
    pairs = [(1, 2), (2, 9), (9, 1), (2, 1)]
    vertices = spark.createDataFrame([(0,), (1,), (2,)], "v BIGINT")
    got = ranks_of(pagerank(edges(pairs), vertices, 2, sink=0))
    assert got == pytest.approx(brute.pagerank(pairs, [0, 1, 2], 2, 0, 2, "none"))


def test_sink_without_in_edges_spreads_nothing(spark, edges):
    vertices = spark.createDataFrame([(0,), (1,), (2,)], "v BIGINT")
    graph = edges([(1, 2), (2, 1)])
    assert ranks_of(pagerank(graph, vertices, 3, sink=0)) == {0: 0.0, 1: 0.5, 2: 0.5}
    ranks = initial_ranks(vertices, 2)
    assert ranks_of(pagerank_step(graph, vertices, ranks, 2, sink=0)) == {0: 0.0, 1: 0.5, 2: 0.5}


def test_sink_is_added_and_start_ranks_are_taken(spark, edges):
    vertices = spark.createDataFrame([(1,), (2,)], "v BIGINT")
    start = spark.createDataFrame([(1, 0.9), (2, 0.1)], "v BIGINT, rank DOUBLE")
    graph = edges([(1, 2), (2, 0)])
    got = ranks_of(pagerank(graph, vertices, 1, sink=0, ranks=start))
    assert got == pytest.approx({0: 0.0, 1: 0.05, 2: 0.95})
    assert ranks_of(pagerank(graph, vertices, 0, sink=0, ranks=start)) == {0: 0.0, 1: 0.9, 2: 0.1}


def test_incoming_rank(spark, edges):
    ranks = spark.createDataFrame([(1, 0.5), (2, 0.25)], "v BIGINT, rank DOUBLE")
    got = incoming_rank(edges([(1, 3), (1, 3), (2, 3), (2, 4), (7, 4)]), ranks)
    assert {r.v: r.inc for r in got.collect()} == {3: 1.25, 4: 0.25}


def test_result_outlives_the_kept_links(spark):
    before = set(spark.sparkContext._jsc.getPersistentRDDs())
    ranks = pagerank(chain_graph(spark, 3), chain_vertices(numbered_vertices(spark, 3)), 2, sink=0)
    assert ranks.agg(F.sum("rank")).first()[0] == pytest.approx(1.0)
    assert set(spark.sparkContext._jsc.getPersistentRDDs()) <= before


@pytest.mark.parametrize("normalize", ["none", "out_degree"])
def test_start_ranks_outside_of_the_vertices_pass_on(spark, edges, normalize):
    graph = edges([(1, 2), (7, 2), (2, 0), (8, 9)])
    vertices = spark.createDataFrame([(0,), (1,), (2,)], "v BIGINT")
    ranks = spark.createDataFrame([(1, 0.25), (2, 0.25), (7, 0.5), (9, 0.5)], "v BIGINT, rank DOUBLE")
    want = ranks_of(pagerank_step(graph, vertices, ranks, 2, 0, normalize))
    assert ranks_of(pagerank(graph, vertices, 1, sink=0, ranks=ranks, normalize=normalize)) == pytest.approx(want)
    if normalize == "none":
        assert want[2] == pytest.approx(0.875)


def test_a_job_and_a_table_per_step(spark, tmp_path, monkeypatch):
    module = importlib.import_module("edgeloom.operators.pagerank")
    tables = []

    def watched(df, name):
        tables.append(stage(df, name))
        return tables[-1]

    monkeypatch.setattr(module, "stage", watched)
    graph, vertices = chain_graph(spark, 4), chain_vertices(numbered_vertices(spark, 4))
    tracker = spark.sparkContext.statusTracker()
    jobs = []
    for steps in (2, 5):
        spark.sparkContext.setJobGroup(f"steps-{steps}", "")
        module.pagerank(graph, vertices, steps, sink=0, normalize="out_degree")
        jobs.append(len(tracker.getJobIdsForGroup(f"steps-{steps}")))
    spark.sparkContext.setJobGroup("other", "")
    executions = (jobs[1] - jobs[0]) / 3
    # a step is one query; adaptive execution gives each of its shuffles a job
    assert executions <= 4
    folders = [Path(t.inputFiles()[0].removeprefix("file://")).parent for t in tables]
    assert [f.exists() for f in folders] == [False, True, False, False, False, False, True]


def test_text_ids(spark):
    edges = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "01")], "src STRING, dst STRING")
    vertices = spark.createDataFrame([("a",), ("b",), ("c",), ("01",)], "v STRING")
    got = ranks_of(pagerank(edges, vertices, 1, sink="01"))
    assert got == pytest.approx({"a": 1 / 9, "b": 4 / 9, "c": 4 / 9, "01": 0.0})


def test_unknown_rule(spark, edges):
    with pytest.raises(ValueError):
        pagerank(edges([]), spark.range(1).withColumnRenamed("id", "v"), 1, normalize="damped")
