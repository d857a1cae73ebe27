import random
from collections import Counter

import pytest

import brute
from edgeloom.operators.paths import path_hubs
from edgeloom import (
    adjacency, degrees, edge_multiplicity, follower_count, follows, max_filter, pair_multiplicity,
    reverse_edges, two_path_count, two_path_degree, two_paths, vertices_of,
)

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def pairs():
    rng = random.Random(1)
    hub = [(0, rng.randrange(60)) for _ in range(80)] + [(rng.randrange(60), 0) for _ in range(80)]
    return hub + [(rng.randrange(60), rng.randrange(60)) for _ in range(160)]


@pytest.mark.parametrize("strategy", ["auto", "shuffle", "broadcast"])
@pytest.mark.parametrize("paths_per_part", [9, 100_000])
def test_two_paths(edges, pairs, strategy, paths_per_part):
    got = two_paths(edges(pairs), strategy, paths_per_part).collect()
    assert Counter({(r.x, r.y, r.z): r.m for r in got}) == brute.two_paths(pairs)
    assert len({(r.x, r.y, r.z) for r in got}) == len(got)


def test_two_path_counts(edges, pairs):
    graph = edges(pairs)
    want = brute.two_paths(pairs)
    assert two_path_count(graph).collect()[0].paths == want.total()
    per_middle = Counter()
    for (_, y, _), m in want.items():
        per_middle[y] += m
    got = {r.v: r.paths for r in two_path_degree(graph).collect()}
    assert {v: p for v, p in got.items() if p} == dict(per_middle)
    assert set(got) == {v for pair in pairs for v in pair}
    assert int(two_path_count(graph, "decimal(38,0)").collect()[0].paths) == want.total()


@pytest.mark.parametrize("block_size", [1, 7, 100_000])
def test_adjacency(edges, pairs, block_size):
    rows = adjacency(edges(pairs), block_size).collect()
    found = Counter()
    for r in rows:
        assert len(r.neighbours) == len(r.copies)
        assert r.neighbours == sorted(set(r.neighbours))
        for dst, copies in zip(r.neighbours, r.copies):
            assert (r.src, dst) not in found
            found[r.src, dst] = copies
    assert found == Counter(pairs)
    blocks = Counter(r.src for r in rows)
    for src, count in blocks.items():
        assert count <= -(-len({b for a, b in pairs if a == src}) // block_size)
    # which degrees are broadcast changes nothing
    few = adjacency(edges(pairs), block_size, max_hubs=2).collect()
    assert sorted(map(tuple, few)) == sorted(map(tuple, rows))


@pytest.mark.parametrize("ids", ["bigint", "string"])
def test_blocks_of_a_hub_with_scattered_ids(spark, ids):
    graph = spark.range(1000).selectExpr(f"CAST(1 AS {ids}) AS src", f"CAST(xxhash64(id) AS {ids}) AS dst")
    sizes = [len(r.neighbours) for r in adjacency(graph, 100).collect()]
    assert sum(sizes) == 1000 and len(sizes) == 10 and max(sizes) < 200


def test_blocks_do_not_depend_on_other_edges(edges):
    own = [(1, v) for v in range(30)]
    alone = {r.block: r.neighbours for r in adjacency(edges(own), 4).collect()}
    others = own + [(v, v + 1) for v in range(100, 2000)]
    beside = {r.block: r.neighbours for r in adjacency(edges(others), 4).collect() if r.src == 1}
    assert alone == beside


def test_cells_of_a_hub_make_few_paths(edges):
    graph = edges([(v, 0) for v in range(1, 201)] + [(0, v) for v in range(1, 401)])
    (hub,) = path_hubs(edge_multiplicity(graph), 4_000).collect()
    assert hub.v == 0 and (200 / hub.parts_left) * (400 / hub.parts_right) <= 4_000
    assert two_paths(graph, "shuffle", 4_000).count() == 80_000 + 200


def test_small_operators(edges, pairs):
    graph = edges(pairs)
    assert Counter(map(tuple, reverse_edges(graph).collect())) == Counter((b, a) for a, b in pairs)
    assert Counter(map(tuple, max_filter(graph, 30).collect())) == Counter(
        (a, b) for a, b in pairs if a < 30 and b < 30)
    assert {(r.src, r.dst): r.m for r in edge_multiplicity(graph).collect()} == Counter(pairs)
    assert {r.v for r in vertices_of(graph).collect()} == {v for pair in pairs for v in pair}
    assert {r.user: r.followers for r in follower_count(graph).collect()} == Counter(b for _, b in pairs)
    for r in degrees(graph).collect():
        assert r.n_out == sum(a == r.v for a, _ in pairs)
        assert r.n_in == sum(b == r.v for _, b in pairs)
    copies = Counter(pairs)
    for r in pair_multiplicity(graph).collect():
        assert r.a <= r.b
        assert r.m_ab == copies[r.a, r.b]
        assert r.m_ba == (copies[r.b, r.a] if r.a != r.b else 0)


def test_max_filter_is_strict(edges):
    kept = max_filter(edges([(1, 2), (2, 3), (3, 1)]), 3).collect()
    assert list(map(tuple, kept)) == [(1, 2)]


def test_totals_on_the_tables(spark):
    graph = follows(spark, SF_DIR)
    assert sum(r.followers for r in follower_count(graph).collect()) == graph.count() == 1500
    assert sum(r.m for r in two_paths(graph).collect()) == two_path_count(graph).collect()[0].paths == 15000
