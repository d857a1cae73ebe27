"""Going on from kept steps, one file of many rows, lines of any length, lists that are probed, every middle vertex split."""

import importlib
import random
from collections import Counter

import pytest

import brute
from edgeloom import (
    chain_graph, chain_vertices, closed_two_path_count, numbered_vertices, pagerank, read_edges, read_ranks,
    read_vertices, triangle_count, two_paths, write_single_file,
)
from edgeloom.operators.paths import path_sides
from edgeloom.plans.hubs import cells

PAGERANK = importlib.import_module("edgeloom.operators.pagerank")


def graph(rng, vertices=30, edges=150):
    return [(rng.randrange(vertices), rng.randrange(vertices)) for _ in range(edges)]


def ranks_of(df):
    return {r.v: r.rank for r in df.collect()}


@pytest.mark.parametrize("normalize, sink", [("none", 0), ("out_degree", 3)])
def test_a_run_goes_on_from_its_last_step(spark, edges, tmp_path, monkeypatch, normalize, sink):
    pairs = [(v, v + 1) for v in range(12)] + [(4, 2), (12, 0), (7, 20)]
    links, vertices = edges(pairs), spark.createDataFrame([(v,) for v in range(21)], "v BIGINT")
    folder = str(tmp_path / "kept")
    want = ranks_of(pagerank(links, vertices, 4, sink=sink, normalize=normalize))
    real, written = PAGERANK.Ledger.write, []

    def fails_at_step_3(self, df, step):
        written.append(step)
        if step == 3 and written.count(3) == 1:
            real(self, df.limit(1), step)  # half a step is left behind
            raise RuntimeError("the driver is lost")
        return real(self, df, step)

    monkeypatch.setattr(PAGERANK.Ledger, "write", fails_at_step_3)
    with pytest.raises(RuntimeError):
        pagerank(links, vertices, 4, sink=sink, normalize=normalize, resume=folder)
    got = ranks_of(pagerank(links, vertices, 4, sink=sink, normalize=normalize, resume=folder))
    assert written == [1, 2, 3, 3, 4]
    assert got == pytest.approx(want)
    assert ranks_of(pagerank(links, vertices, 4, sink=sink, normalize=normalize, resume=folder)) == pytest.approx(want)
    assert written == [1, 2, 3, 3, 4]
    assert sorted(p.name for p in (tmp_path / "kept").iterdir()) == ["ledger", "step-000003", "step-000004"]


def test_steps_of_another_graph_are_refused(spark, tmp_path):
    vertices = chain_vertices(numbered_vertices(spark, 3))
    pagerank(chain_graph(spark, 3), vertices, 2, sink=0, resume=str(tmp_path / "kept"))
    with pytest.raises(ValueError):
        pagerank(chain_graph(spark, 3), vertices, 3, sink=0, normalize="out_degree", resume=str(tmp_path / "kept"))
    with pytest.raises(ValueError):
        pagerank(chain_graph(spark, 4), vertices, 3, sink=0, resume=str(tmp_path / "kept"))


@pytest.mark.parametrize("style", ["delimited", "tuple"])
def test_single_file_of_many_tasks(spark, tmp_path, style):
    path = tmp_path / "out" / "ranks.txt"
    rows = spark.range(1000).selectExpr("id % 50 AS k", "id * 7 % 1000 AS v").repartition(5)
    before = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("single", "")
    write_single_file(rows, str(path), style=style, tasks=6)
    stages = [before.getStageInfo(s) for j in before.getJobIdsForGroup("single") for s in before.getJobInfo(j).stageIds]
    spark.sparkContext.setJobGroup("other", "")
    assert max(s.numTasks for s in stages if s) >= 6
    assert path.is_file() and {p.name.strip(".").removesuffix(".crc") for p in path.parent.iterdir()} == {"ranks.txt"}
    want = sorted((i % 50, i * 7 % 1000) for i in range(1000))
    text = "({},{})" if style == "tuple" else "{},{}"
    assert path.read_text().splitlines() == [text.format(*r) for r in want]
    with pytest.raises(FileExistsError):
        write_single_file(rows, str(path))
    write_single_file(rows.limit(0), str(path), overwrite=True)
    assert path.read_text() == ""


def test_one_long_line_is_read_by_several_tasks(spark, tmp_path):
    pairs = graph(random.Random(2), 10_000, 40_000)
    (tmp_path / "edges.txt").write_text(" ".join(f"{a},{b}" for a, b in pairs))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64k")
    try:
        found = read_edges(spark, str(tmp_path), scan="blanks")
        counts = found.selectExpr("spark_partition_id() AS task").groupBy("task").count().collect()
        assert len([r for r in counts if r["count"] > 100]) >= 4
        assert Counter(map(tuple, found.collect())) == Counter(pairs)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_scans_by_lines_and_by_blanks_read_the_same(spark, tmp_path):
    (tmp_path / "e.txt").write_text("1,2 3,4\r\n5,6\n\n  7,8,9,10 \r11,12")
    (tmp_path / "r.txt").write_text("1,0.5\n2,0.25 3,1e-3\n")
    for read, name in ((read_edges, "e.txt"), (read_ranks, "r.txt"), (read_vertices, "r.txt")):
        by_lines, by_blanks = (Counter(map(tuple, read(spark, str(tmp_path / name), scan=s).collect())) for s in ("lines", "blanks"))
        assert by_lines == by_blanks and by_lines
    with pytest.raises(ValueError):
        read_edges(spark, str(tmp_path), scan="words")


@pytest.mark.parametrize("max_hubs", [1, 5, 1_000_000])
def test_every_middle_vertex_is_split(edges, max_hubs):
    rng = random.Random(8)
    pairs = [(rng.randrange(400), y) for y in range(6) for _ in range(120)] + [(y, rng.randrange(400)) for y in range(6) for _ in range(90)]
    pairs += [(rng.randrange(400), rng.randrange(400)) for _ in range(300)]
    bound = 400
    into, out = path_sides(edges(pairs), bound, max_hubs)
    cell = ["y", "left_part", "right_part"]
    left, right = (Counter(tuple(r) for r in cells(*side).select(*cell).collect())
                   for side in ((into, "left", "x", "right"), (out, "right", "z", "left")))
    # parts are dealt by a hash, so a cell holds about the bound
    assert max(n * right[c] for c, n in left.items()) <= 4 * bound
    got = two_paths(edges(pairs), "auto", bound, max_hubs=max_hubs).collect()
    assert Counter({(r.x, r.y, r.z): r.m for r in got}) == brute.two_paths(pairs)


@pytest.mark.parametrize("block_entries", [1, 40, 2_000_000])
@pytest.mark.parametrize("multiplicity", ["distinct", "all", "closing_exists"])
def test_lists_find_what_joins_find(edges, multiplicity, block_entries):
    pairs = graph(random.Random(5), 14, 260) + [(100, 101), (101, 102)]
    found = closed_two_path_count(edges(pairs), multiplicity, "lists", block_entries=block_entries).first().closed
    assert found == closed_two_path_count(edges(pairs), multiplicity, "shuffle").first().closed > 0


def test_lists_look_up_in_bounded_steps(edges, monkeypatch):
    monkeypatch.setattr(importlib.import_module("edgeloom.operators.lists"), "PATHS_AT_ONCE", 3)
    pairs = graph(random.Random(6), 14, 200)
    assert triangle_count(edges(pairs), "all", "lists").first() == triangle_count(edges(pairs), "all").first()


def test_lists_of_nothing_and_of_text(spark, edges):
    assert triangle_count(edges([]), strategy="lists").first().triangles == 0
    assert triangle_count(edges([(1, 2), (2, 2)]), strategy="lists").first().triangles == 0
    with pytest.raises(ValueError):
        triangle_count(spark.createDataFrame([("a", "b")], "src STRING, dst STRING"), strategy="lists")


def test_lists_count_beyond_64_bits_is_exact(spark):
    big = spark.range(3).selectExpr("id AS src", "(id + 1) % 3 AS dst", "explode(sequence(1, 300)) AS copy").select("src", "dst")
    assert triangle_count(big, "all", "lists", "decimal(38,0)").first().triangles == 300 ** 3
    lists = importlib.import_module("edgeloom.operators.lists")
    np = lists.np
    huge = np.array([3_000_000_000], np.int64)
    assert lists.count_closed(huge, huge, huge, "all") == 3 * 3_000_000_000 ** 3
