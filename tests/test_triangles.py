import importlib
import random

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

import brute
from edgeloom import closed_two_path_count, triangle_count, triangles, two_path_count

module = importlib.import_module("edgeloom.operators.triangles")

TRIANGLE = [(1, 2), (2, 3), (3, 1)]

# name: edges, two-paths, closed "all", closed "closing_exists", distinct triangles
GRAPHS = {
    "triangle": (TRIANGLE, 3, 3, 3, 1),
    "copies 2,3,1": ([(1, 2)] * 2 + [(2, 3)] * 3 + [(3, 1)], 11, 18, 11, 1),
    "reciprocal pair": ([(1, 2), (2, 1)], 2, 0, 0, 0),
    "self-loop": ([(5, 5)], 1, 1, 1, 0),
    "loop and pair": ([(1, 1), (1, 2), (2, 1)], 5, 4, 4, 0),
    "triangle and loop": (TRIANGLE + [(1, 1)], 6, 4, 4, 1),
    "triangle and back edge": (TRIANGLE + [(2, 1)], 5, 3, 3, 1),
    "empty": ([], 0, 0, 0, 0),
}


def one(df):
    (row,) = df.collect()
    return row[0]


@pytest.mark.parametrize("name", GRAPHS)
def test_known_graphs(edges, name):
    pairs, paths, closed_all, closed_exists, cycles = GRAPHS[name]
    graph = edges(pairs)
    assert one(two_path_count(graph)) == paths
    assert one(closed_two_path_count(graph, "all")) == closed_all
    assert one(closed_two_path_count(graph, "closing_exists")) == closed_exists
    assert one(triangle_count(graph)) == cycles


@pytest.mark.parametrize("seed", range(3))
def test_random_multigraphs(edges, seed):
    rng = random.Random(seed)
    size = rng.randint(3, 7)
    pairs = [(rng.randrange(size), rng.randrange(size)) for _ in range(15 if seed else 60)]
    graph = edges(pairs).cache()
    for multiplicity in ("distinct", "all", "closing_exists"):
        want = brute.closed_two_paths(pairs, multiplicity)
        for strategy in ("shuffle", "broadcast"):
            assert one(closed_two_path_count(graph, multiplicity, strategy)) == want
    assert sorted(map(tuple, triangles(graph).collect())) == brute.triangles(pairs)
    graph.unpersist()


def test_random_larger_graph_agrees_over_strategies(edges):
    rng = random.Random(11)
    pairs = [(rng.randrange(40), rng.randrange(40)) for _ in range(500)]
    graph = edges(pairs)
    for multiplicity in ("distinct", "all", "closing_exists"):
        want = brute.closed_two_paths(pairs, multiplicity)
        for strategy in ("shuffle", "broadcast"):
            assert one(closed_two_path_count(graph, multiplicity, strategy)) == want
    assert sorted(map(tuple, triangles(graph, "shuffle").collect())) == brute.triangles(pairs)


def test_rules_agree_on_simple_graphs(edges):
    rng = random.Random(3)
    pairs = {(rng.randrange(12), rng.randrange(12)) for _ in range(70)}
    graph = edges([(a, b) for a, b in pairs if a != b])
    counts = {one(triangle_count(graph, m)) for m in ("distinct", "all", "closing_exists")}
    assert len(counts) == 1
    assert triangles(graph).count() == counts.pop()


def test_hub_in_a_third_of_all_edges(edges):
    rng = random.Random(5)
    pairs = [(0, v) if rng.random() < 0.5 else (v, 0) for v in range(1, 200)]
    pairs += [(rng.randrange(1, 200), rng.randrange(1, 200)) for _ in range(400)]
    graph = edges(pairs)
    for multiplicity in ("distinct", "all", "closing_exists"):
        assert one(closed_two_path_count(graph, multiplicity)) == brute.closed_two_paths(pairs, multiplicity)


def test_two_hubs_with_many_common_neighbours(edges):
    pairs = [(v, 0) for v in range(2, 120)] + [(1, v) for v in range(2, 120)] + [(0, 1), (0, 2), (2, 1)]
    want = brute.triangles(pairs)
    assert len(want) == 118
    for strategy in ("shuffle", "broadcast"):
        for rows_per_part in (1, 10, 100_000):
            got = triangles(edges(pairs), strategy, rows_per_part=rows_per_part).collect()
            assert sorted(map(tuple, got)) == want


def test_broadcast_beyond_its_bound_still_counts(edges):
    plan = triangle_count(edges(TRIANGLE), strategy="broadcast", broadcast_rows=2)
    assert one(plan) == 1


@pytest.mark.parametrize("copies, want", [((2, 3, 1), (6, 3)), ((1, 1, 1), (1, 1))])
def test_a_third_of_the_closed_paths_rounded_down(edges, copies, want):
    graph = edges([edge for edge, n in zip(TRIANGLE, copies) for _ in range(n)])
    assert (one(triangle_count(graph, "all")), one(triangle_count(graph, "closing_exists"))) == want


def test_counts_beyond_64_bits(spark):
    copies = 3_000_000
    ends = F.expr("explode(array(struct(1L AS src, 2L AS dst), struct(2L AS src, 3L AS dst), struct(3L AS src, 1L AS dst)))")
    many = spark.range(copies).select(ends.alias("e")).select("e.*")
    assert int(one(triangle_count(many, "all", count_type="decimal(38,0)"))) == copies**3 > 2**63
    ansi = spark.conf.get("spark.sql.ansi.enabled")
    try:
        for setting in ("true", "false"):
            spark.conf.set("spark.sql.ansi.enabled", setting)
            with pytest.raises(PySparkException, match="OVERFLOW"):
                one(triangle_count(many, "all"))
            assert one(triangle_count(many, "closing_exists")) == copies**2
    finally:
        spark.conf.set("spark.sql.ansi.enabled", ansi)


@pytest.mark.parametrize("strategy", ["shuffle", "broadcast"])
def test_bounds_change_neither_counts_nor_paths(spark, edges, strategy):
    rng = random.Random(7)
    pairs = [(0, v) if rng.random() < 0.5 else (v, 0) for v in range(1, 40)]
    pairs += [(rng.randrange(40), rng.randrange(40)) for _ in range(300)]
    graph = edges(pairs)
    for multiplicity in ("distinct", "all", "closing_exists"):
        want = brute.closed_two_paths(pairs, multiplicity)
        for middle_rows, max_hubs in ((1, 3), (2, 1000)):
            assert one(closed_two_path_count(graph, multiplicity, strategy, middle_rows=middle_rows, max_hubs=max_hubs)) == want
    paths = set()
    for middle_rows, max_hubs in ((1, 3), (5, 20), (3000, 1_000_000)):
        folded = module._folded_pairs(graph, True, "bigint")
        joins = module._Joins(folded, strategy, 2_000_000, middle_rows, max_hubs)
        paths.add(joins.low_middle_paths(module._ranked(folded, max_hubs)).count())
        assert sorted(map(tuple, triangles(graph, strategy, middle_rows=middle_rows, max_hubs=max_hubs).collect())) == brute.triangles(pairs)
    assert len(paths) == 1


def test_text_ids(spark):
    graph = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "a"), ("a", "c")], "src STRING, dst STRING")
    assert one(triangle_count(graph)) == 1
    assert list(map(tuple, triangles(graph).collect())) == [("a", "b", "c")]


def test_unknown_choices(edges):
    with pytest.raises(ValueError):
        triangle_count(edges([]), "some")
    with pytest.raises(ValueError):
        triangle_count(edges([]), strategy="magic")


def test_lists_travel_by_the_root_of_the_blocks():
    lists = importlib.import_module("edgeloom.operators.lists")
    for entries, block_entries in ((36_000_000, 2_000_000), (900_000, 1_000), (1_000_000_000, 2_000_000)):
        colours, shares = lists.layout(entries, block_entries, 200)
        assert colours * colours >= entries / block_entries
        # was one time per block, and one per task
        assert 2 * colours + shares <= 3 * (entries / block_entries) ** 0.5 + 25
    rng = random.Random(1)
    pairs = sorted({(rng.randrange(100), rng.randrange(100, 200)) for _ in range(2000)})
    entries = lists.np.array([[v, w, 1, 0] for v, w in pairs]).T
    held, passed = 0, 0
    for _, kind, body in lists.deal(entries, 5, 2):
        arrays = lists.unpack(body)
        held += len(arrays[0]) if kind == 0 else 0
        passed += sum(len(a) for a in arrays[2::4]) if kind else 0
    assert held == 2 * len(pairs) and passed <= 2 * 5 * len(pairs)


def test_dense_triangles_without_rows_for_paths(edges, monkeypatch):
    monkeypatch.setattr(module, "DENSE_DEGREE", 10)
    rng = random.Random(2)
    pairs = [(rng.randrange(-20, 20), rng.randrange(-20, 20)) for _ in range(900)]
    found = triangles(edges(pairs))
    assert sorted(map(tuple, found.collect())) == brute.triangles(pairs)
    assert "MapInArrow" in found._jdf.queryExecution().toString()
    few = edges(pairs[:300])
    for block_entries in (1, 50, 2_000_000):
        got = triangles(few, "lists", block_entries=block_entries).collect()
        assert sorted(map(tuple, got)) == brute.triangles(pairs[:300])


def test_packed_numbers_of_any_range():
    lists = importlib.import_module("edgeloom.operators.lists")
    arrays = [lists.np.array(a, lists.np.int64) for a in ([], [5], [0, 255], [-1, 255], [-2**63, 2**63 - 1, 0], [7, 70_000])]
    assert [list(a) for a in lists.unpack(lists.pack(*arrays))] == [list(a) for a in arrays]
