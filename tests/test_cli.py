import pytest

from edgeloom.cli import run


def text(path):
    return sorted(line for f in path.glob("part-*") for line in f.read_text().splitlines())


@pytest.fixture
def graph(tmp_path):
    (tmp_path / "graph").mkdir()
    (tmp_path / "graph" / "a").write_text("1,2 2,3\n3,1\n\n1,2\n10,1\n")
    return tmp_path


@pytest.mark.parametrize("args, want", [
    (["followers"], ["1,2", "2,2", "3,1"]),
    (["followers", "--style", "tuple", "--ids", "string"], ["(1,2)", "(2,2)", "(3,1)"]),
    (["max-filter", "3"], ["1,2", "1,2"]),
    (["two-path-count", "--sep", ":"], ["two-paths:7"]),
    (["two-path-count", "10"], ["two-paths,5"]),
    (["triangle-count"], ["triangles,1"]),
    (["triangle-count", "10", "--multiplicity", "all", "--strategy", "broadcast"], ["triangles,2"]),
    (["triangle-count", "3"], ["triangles,0"]),
])
def test_program(spark, graph, args, want):
    program, *rest = args
    numbers = [a for a in rest if a.isdigit()]
    options = [a for a in rest if not a.isdigit()]
    run(spark, [program, str(graph / "graph"), str(graph / "out"), *numbers, *options])
    assert text(graph / "out") == want


def test_chains_and_ranks(spark, tmp_path):
    run(spark, ["chains", str(tmp_path / "chains"), "2"])
    assert text(tmp_path / "chains" / "graph.txt") == ["1,2", "2,0", "3,4", "4,0"]
    assert text(tmp_path / "chains" / "rank.txt") == ["0,0.0", "1,0.25", "2,0.25", "3,0.25", "4,0.25"]
    run(spark, ["pagerank", str(tmp_path / "chains"), str(tmp_path / "ranks"), "1"])
    assert text(tmp_path / "ranks") == ["0,0.0", "1,0.125", "2,0.375", "3,0.125", "4,0.375"]


def test_malformed_input_is_dropped_on_request(spark, graph):
    (graph / "graph" / "b").write_text("x,1 4,1\n")
    run(spark, ["followers", str(graph / "graph"), str(graph / "out"), "--mode", "drop"])
    assert text(graph / "out") == ["1,3", "2,2", "3,1"]
