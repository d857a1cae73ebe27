import pytest
from pyspark.errors import PySparkException

from edgeloom import (
    follower_count, format_pairs, parse_edges, parse_ranks, parse_vertices, read_edges, read_ranks, read_vertices,
    triangle_count,
    write_labelled, write_pairs,
)


def lines(spark, *text):
    return spark.createDataFrame([(t,) for t in text], "value STRING")


def rows(df):
    return sorted(map(tuple, df.collect()))


@pytest.mark.parametrize("line, want", [
    ("1,2", [(1, 2)]),
    ("1,2 3,4", [(1, 2), (3, 4)]),
    ("1,2,3,4", [(1, 2), (3, 4)]),
    ("1,2,3,4,5,6 7,8", [(1, 2), (3, 4), (5, 6), (7, 8)]),
    ("", []),
    ("   ", []),
    (" 1,2   3,4 ", [(1, 2), (3, 4)]),
    ("-1,9223372036854775807", [(-1, 9223372036854775807)]),
])
def test_wellformed_lines(spark, line, want):
    assert rows(parse_edges(lines(spark, line))) == want


@pytest.mark.parametrize("line", ["7", "1,2,3", "a,b", "1,", ",2", "1,,2", "1,9223372036854775808", "1,2,3,x"])
def test_malformed_words(spark, line):
    with pytest.raises(PySparkException, match="malformed edge"):
        parse_edges(lines(spark, line)).collect()
    assert rows(parse_edges(lines(spark, f"5,6 {line} 7,8"), mode="drop")) == [(5, 6), (7, 8)]


def test_malformed_line_fails_though_only_one_column_is_used(spark):
    with pytest.raises(PySparkException, match="malformed edge"):
        follower_count(parse_edges(lines(spark, "x,2"))).collect()


def test_text_ids(spark):
    edges = parse_edges(lines(spark, "a,01 b,1 c,01"), id_type="string")
    assert rows(follower_count(edges)) == [("01", 2), ("1", 1)]


def test_unknown_modes(spark):
    with pytest.raises(ValueError):
        parse_edges(lines(spark, "1,2"), mode="maybe")
    with pytest.raises(ValueError):
        parse_edges(lines(spark, "1,2"), id_type="float")


def test_files(spark, tmp_path):
    (tmp_path / "edges").mkdir()
    (tmp_path / "edges" / "a.txt").write_text("1,2\n\n2,3 3,1\n")
    (tmp_path / "edges" / "b.txt").write_text("4,5,6,7\r\n")
    assert rows(read_edges(spark, str(tmp_path / "edges"))) == [(1, 2), (2, 3), (3, 1), (4, 5), (6, 7)]
    (tmp_path / "rank.txt").write_text("0,0\n1,1.0E-4\n")
    assert rows(read_ranks(spark, str(tmp_path / "rank.txt"))) == [(0, 0.0), (1, 1e-4)]
    (tmp_path / "vertex.txt").write_text("0,0\n12,0\n")
    assert rows(read_vertices(spark, str(tmp_path / "vertex.txt"))) == [(0,), (12,)]


def files(path):
    return [f.read_text().splitlines() for f in sorted(path.glob("part-*")) if f.stat().st_size]


def test_pairs_and_tuples(spark, tmp_path):
    ranks = spark.createDataFrame([(1, 1.0936852726843606e-06), (2, 0.0)], "v BIGINT, rank DOUBLE")
    write_pairs(ranks, str(tmp_path / "p"), sep=":")
    assert sorted(sum(files(tmp_path / "p"), [])) == ["1:1.0936852726843606E-6", "2:0.0"]
    assert rows(format_pairs(ranks, style="tuple"))[0] == ("(1,1.0936852726843606E-6)",)
    write_pairs(ranks, str(tmp_path / "csv"), style="csv")
    assert sum(files(tmp_path / "csv"), []).count("2,0.0") == 1


def test_sorted_keys_are_in_text_order_and_in_one_file_each(spark, edges, tmp_path):
    graph = edges([(i, i * 7 % 113) for i in range(400)])
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # which would put this little into one file
    try:
        write_pairs(follower_count(graph), str(tmp_path / "f"), sort_keys=True)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    parts = [[line.split(",")[0] for line in part] for part in files(tmp_path / "f")]
    assert len(parts) > 1
    assert all(part == sorted(part) for part in parts)
    keys = sum(parts, [])
    assert sorted(keys) == sorted(set(keys)) and len(keys) == 113


def test_label(spark, edges, tmp_path):
    write_labelled(triangle_count(edges([(1, 2), (2, 3), (3, 1)])), str(tmp_path / "n"), "count", sep=":")
    assert files(tmp_path / "n") == [["count:1"]]


@pytest.mark.parametrize("parse, good, want, bad", [
    (parse_ranks, "1,0.5  2,1e-3", [(1, 0.5), (2, 1e-3)], ["2,", ",0.25", "x,0.25", "1", "1,2,3", "1,z"]),
    (parse_vertices, "1,0 2,0 3", [(1,), (2,), (3,)], ["x,0", ",0", "1,0,0", "1.5,0"]),
])
def test_ranks_and_vertices(spark, parse, good, want, bad):
    assert rows(parse(lines(spark, good, "", "  "))) == want
    for word in bad:
        parsed = parse(lines(spark, f"5,7 {word}"))
        for column in parsed.columns:
            with pytest.raises(PySparkException, match="malformed"):
                parsed.select(column).collect()
        assert len(rows(parse(lines(spark, f"5,7 {word}"), mode="drop"))) == 1
    assert rows(parse(lines(spark, "01,1"), id_type="string"))[0][0] == "01"
    with pytest.raises(ValueError):
        parse(lines(spark, "1,1"), mode="maybe")


def test_unknown_style(spark, tmp_path):
    with pytest.raises(ValueError, match="style"):
        write_pairs(spark.range(4), str(tmp_path / "big"), style="xml")
