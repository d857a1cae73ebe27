"""The registered queries, each over whole tables, with SQL that gives the same rows.

Three follow graphs come out of the tables: ``follows`` and ``follows_skewed`` (an edge per order, the latter with
hubs) and ``follows_dense`` (an edge per line item, with many copies and loops). The chains are
made of the order keys. SQL is left out only where there is none.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import edgeloom as el
from edgeloom.plans import scratch_path

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

CHAIN = 100  # vertices per chain
SMALL_BLOCK = 32  # neighbours per block in adjacency_blocks

FOLLOWS = "SELECT o_custkey AS src, o_orderkey % (SELECT count(*) FROM customer) AS dst FROM orders"
DENSE = "SELECT l_suppkey AS src, l_partkey % (SELECT count(*) FROM supplier) AS dst FROM lineitem"
SKEWED = """SELECT o_custkey AS src, ((o_orderkey % 1000) * (o_orderkey % 1000) * (o_orderkey % 1000)
  * (SELECT count(*) FROM customer)) // 1000000000 AS dst FROM orders"""
CHAINS = f"""
SELECT o_orderkey + 1 AS src,
       CASE WHEN (o_orderkey + 1) % {CHAIN} = 0 OR o_orderkey + 1 = (SELECT count(*) FROM orders)
            THEN 0 ELSE o_orderkey + 2 END AS dst
FROM orders"""
CHAIN_VERTICES = "SELECT o_orderkey + 1 AS v FROM orders UNION ALL SELECT CAST(0 AS BIGINT)"
CUSTOMERS = "SELECT c_custkey AS v FROM customer"
SUPPLIERS = "SELECT s_suppkey AS v FROM supplier"


def query(name: str, sql: str | None = None):
    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql:
            ORACLES[name] = sql
        return fn

    return register


def over(edges: str, sql: str) -> str:
    return f"WITH e AS ({edges}) {sql}"


# --- counting -------------------------------------------------------------------

FOLLOWERS_SQL = "SELECT dst AS user, count(*) AS followers FROM e GROUP BY dst"


@query("follower_count", over(FOLLOWS, FOLLOWERS_SQL))
def follower_count(spark, d):
    return el.follower_count(el.follows(spark, d))


@query("follower_count_dense", over(DENSE, FOLLOWERS_SQL))
def follower_count_dense(spark, d):
    return el.follower_count(el.follows_dense(spark, d))


@query("follower_count_text_ids",
       over(FOLLOWS, "SELECT CAST(dst AS VARCHAR) AS user, count(*) AS followers FROM e GROUP BY dst"))
def follower_count_text_ids(spark, d):
    lines = el.format_pairs(el.follows(spark, d))
    return el.follower_count(el.parse_edges(lines, id_type="string"))


def half_of_users(spark, d) -> int:
    return el.table(spark, d, "customer").count() // 2


HALF = "SELECT * FROM e WHERE src < (SELECT count(*) FROM customer) // 2 AND dst < (SELECT count(*) FROM customer) // 2"


@query("max_filter", over(FOLLOWS, HALF))
def max_filter(spark, d):
    return el.max_filter(el.follows(spark, d), half_of_users(spark, d))


@query("reverse_edges", over(FOLLOWS, "SELECT dst AS src, src AS dst FROM e"))
def reverse_edges(spark, d):
    return el.reverse_edges(el.follows(spark, d))


@query("vertices", over(FOLLOWS, "SELECT src AS v FROM e UNION SELECT dst FROM e"))
def vertices(spark, d):
    return el.vertices_of(el.follows(spark, d))


@query("edge_multiplicity", over(DENSE, "SELECT src, dst, count(*) AS m FROM e GROUP BY src, dst"))
def edge_multiplicity(spark, d):
    return el.edge_multiplicity(el.follows_dense(spark, d))


@query("pair_multiplicity", over(DENSE, """
SELECT least(src, dst) AS a, greatest(src, dst) AS b,
       CAST(sum(CASE WHEN src <= dst THEN 1 ELSE 0 END) AS BIGINT) AS m_ab,
       CAST(sum(CASE WHEN src > dst THEN 1 ELSE 0 END) AS BIGINT) AS m_ba
FROM e GROUP BY 1, 2"""))
def pair_multiplicity(spark, d):
    return el.pair_multiplicity(el.follows_dense(spark, d))


ENDS_SQL = """
, ends AS (SELECT src AS v, 1 AS o, 0 AS i FROM e UNION ALL SELECT dst, 0, 1 FROM e),
deg AS (SELECT v, CAST(sum(o) AS BIGINT) AS n_out, CAST(sum(i) AS BIGINT) AS n_in FROM ends GROUP BY v)
"""


@query("degrees", over(FOLLOWS, ENDS_SQL + "SELECT * FROM deg"))
def degrees(spark, d):
    return el.degrees(el.follows(spark, d))


@query("two_path_degree", over(FOLLOWS, ENDS_SQL + "SELECT v, n_out * n_in AS paths FROM deg"))
def two_path_degree(spark, d):
    return el.two_path_degree(el.follows(spark, d))


PATH_COUNT_SQL = "SELECT CAST(coalesce(sum(n_out * n_in), 0) AS BIGINT) AS paths FROM deg"


@query("two_path_count", over(FOLLOWS, ENDS_SQL + PATH_COUNT_SQL))
def two_path_count(spark, d):
    return el.two_path_count(el.follows(spark, d))


@query("two_path_count_dense", over(DENSE, ENDS_SQL + PATH_COUNT_SQL))
def two_path_count_dense(spark, d):
    return el.two_path_count(el.follows_dense(spark, d))


@query("two_path_count_max_filter", f"WITH a AS ({FOLLOWS}), e AS ({HALF.replace('FROM e', 'FROM a')})"
       + ENDS_SQL + PATH_COUNT_SQL)
def two_path_count_max_filter(spark, d):
    return el.two_path_count(max_filter(spark, d))


# --- paths and neighbours ---------------------------------------------------------

TWO_PATHS_SQL = """
SELECT a.src AS x, a.dst AS y, b.dst AS z, count(*) AS m
FROM e a JOIN e b ON a.dst = b.src GROUP BY 1, 2, 3"""

for _strategy in ("shuffle", "broadcast"):
    query(f"two_paths_{_strategy}", over(FOLLOWS, TWO_PATHS_SQL))(
        lambda spark, d, s=_strategy: el.two_paths(el.follows(spark, d), s))


@query("two_paths_skewed", over(SKEWED, TWO_PATHS_SQL))
def two_paths_skewed(spark, d):
    return el.two_paths(el.follows_skewed(spark, d), paths_per_part=400)


@query("two_paths_every_middle_split", over(SKEWED, TWO_PATHS_SQL))
def two_paths_every_middle_split(spark, d):
    return el.two_paths(el.follows_skewed(spark, d), paths_per_part=400, max_hubs=1)


NEIGHBOURS_SQL = "SELECT src, dst AS neighbour, count(*) AS copies FROM e GROUP BY src, dst"


def neighbours(adjacency: DataFrame) -> DataFrame:
    return adjacency.selectExpr("src", "inline(arrays_zip(neighbours, copies))").withColumnRenamed("neighbours", "neighbour")


@query("adjacency", over(FOLLOWS, NEIGHBOURS_SQL))
def adjacency(spark, d):
    return neighbours(el.adjacency(el.follows(spark, d)))


@query("adjacency_blocks", over(DENSE, NEIGHBOURS_SQL))
def adjacency_blocks(spark, d):
    return neighbours(el.adjacency(el.follows_dense(spark, d), SMALL_BLOCK, max_hubs=10))


@query("adjacency_text_ids", over(SKEWED, """
SELECT CAST(src AS VARCHAR) AS src, CAST(dst AS VARCHAR) AS neighbour, count(*) AS copies FROM e GROUP BY src, dst"""))
def adjacency_text_ids(spark, d):
    lines = el.format_pairs(el.follows_skewed(spark, d))
    return neighbours(el.adjacency(el.parse_edges(lines, id_type="string"), 4))


@query("adjacency_block_bound", over(DENSE, f"""
, w AS (SELECT DISTINCT src, dst FROM e)
SELECT src, count(*) AS neighbours, CAST(1 AS BIGINT) AS few_blocks FROM w GROUP BY src"""))
def adjacency_block_bound(spark, d):
    blocks = el.adjacency(el.follows_dense(spark, d), SMALL_BLOCK)
    return blocks.groupBy("src").agg(F.sum(F.size("neighbours")).alias("neighbours"), F.count("*").alias("blocks")).selectExpr(
        "src", "neighbours", f"IF(blocks <= ceil(neighbours / {SMALL_BLOCK}), 1L, 0L) AS few_blocks")


# --- triangles ----------------------------------------------------------------------

SIMPLE = "(SELECT DISTINCT src, dst FROM e WHERE src <> dst)"
COPIES = "(SELECT src, dst, count(*) AS m FROM e GROUP BY src, dst)"
CLOSED = {
    "distinct": "count(*)",
    "all": "sum(a.m * b.m * c.m)",
    "closing_exists": "sum(a.m * b.m)",
}


def triangle_sql(edges: str, multiplicity: str, extra: str = "") -> str:
    folded = SIMPLE if multiplicity == "distinct" else COPIES
    return f"""
WITH {extra}e AS ({edges}), w AS MATERIALIZED {folded}
SELECT CAST(coalesce({CLOSED[multiplicity]}, 0) // 3 AS BIGINT) AS triangles
FROM w a JOIN w b ON a.dst = b.src JOIN w c ON c.src = b.dst AND c.dst = a.src"""


for _multiplicity in CLOSED:
    for _strategy in ("shuffle", "broadcast"):
        query(f"triangle_count_{_multiplicity}_{_strategy}", triangle_sql(FOLLOWS, _multiplicity))(
            lambda spark, d, m=_multiplicity, s=_strategy: el.triangle_count(el.follows(spark, d), m, s))
    query(f"triangle_count_dense_{_multiplicity}", triangle_sql(DENSE, _multiplicity))(
        lambda spark, d, m=_multiplicity: el.triangle_count(el.follows_dense(spark, d), m, "lists"))
    query(f"triangle_count_list_blocks_{_multiplicity}", triangle_sql(SKEWED, _multiplicity))(
        lambda spark, d, m=_multiplicity: el.triangle_count(el.follows_skewed(spark, d), m, "lists", block_entries=1000))


for _multiplicity in CLOSED:
    query(f"triangle_count_skewed_{_multiplicity}", triangle_sql(SKEWED, _multiplicity))(
        lambda spark, d, m=_multiplicity: el.triangle_count(el.follows_skewed(spark, d), m, middle_rows=4, max_hubs=10))


@query("triangle_count_max_filter", triangle_sql(HALF.replace("FROM e", "FROM g"), "distinct", f"g AS ({FOLLOWS}), "))
def triangle_count_max_filter(spark, d):
    return el.triangle_count(max_filter(spark, d))


@query("triangle_count_labelled", f"""
SELECT 'triangles in all:' || CAST(triangles AS VARCHAR) AS value FROM ({triangle_sql(FOLLOWS, "distinct")})""")
def triangle_count_labelled(spark, d):
    path = scratch_path(spark, "labelled")
    el.write_labelled(el.triangle_count(el.follows(spark, d)), path, "triangles in all", sep=":")
    return spark.read.text(path)


@query("closed_two_path_count", triangle_sql(FOLLOWS, "all").replace(" // 3", "").replace("AS triangles", "AS closed"))
def closed_two_path_count(spark, d):
    return el.closed_two_path_count(el.follows(spark, d), "all")


TRIANGLES_SQL = f"""
, w AS MATERIALIZED {SIMPLE}
SELECT a.src AS x, a.dst AS y, b.dst AS z
FROM w a JOIN w b ON a.dst = b.src JOIN w c ON c.src = b.dst AND c.dst = a.src
WHERE a.src < a.dst AND a.src < b.dst"""


@query("triangles", over(FOLLOWS, TRIANGLES_SQL))
def triangles(spark, d):
    return el.triangles(el.follows(spark, d))


@query("triangles_dense", over(DENSE, TRIANGLES_SQL))
def triangles_dense(spark, d):
    return el.triangles(el.follows_dense(spark, d))


@query("triangles_skewed", over(SKEWED, TRIANGLES_SQL))
def triangles_skewed(spark, d):
    return el.triangles(el.follows_skewed(spark, d), rows_per_part=8, middle_rows=4, max_hubs=10)


@query("write_single_file_roundtrip", over(FOLLOWS, """
SELECT src, dst, count(*) AS lines, CAST(1 AS BIGINT) AS files FROM e GROUP BY src, dst"""))
def write_single_file_roundtrip(spark, d):
    path = scratch_path(spark, "single")
    el.write_single_file(el.follows(spark, d), path)
    lines = spark.read.text(path).select("value", "_metadata.file_path")
    files = lines.select("file_path").distinct().count()
    return el.parse_edges(lines).groupBy("src", "dst").agg(F.count("*").alias("lines")).withColumn("files", F.lit(files).cast("bigint"))


@query("read_edges_one_line", over(FOLLOWS, "SELECT src, dst FROM e"))
def read_edges_one_line(spark, d):
    # each file is one long line of words
    path = scratch_path(spark, "one-line")
    el.format_pairs(el.follows(spark, d)).write.option("lineSep", " ").text(path)
    return el.read_edges(spark, path, scan="blanks")


# --- chains and ranks ---------------------------------------------------------------


def chain_keys(spark, d) -> DataFrame:
    return el.table(spark, d, "orders").selectExpr("o_orderkey + 1 AS v")


@query("chain_graph", CHAINS)
def chain_graph(spark, d):
    orders = chain_keys(spark, d)
    return el.chain_edges(orders, CHAIN, orders.count())


@query("chain_vertices", CHAIN_VERTICES)
def chain_vertices(spark, d):
    return el.chain_vertices(chain_keys(spark, d))


@query("initial_ranks", f"""
SELECT v, CASE WHEN v = 0 THEN CAST(0 AS DOUBLE)
               ELSE CAST(1 AS DOUBLE) / (SELECT count(*) FROM orders) END AS rank
FROM ({CHAIN_VERTICES})""")
def initial_ranks(spark, d):
    return el.initial_ranks(chain_vertices(spark, d), chain_keys(spark, d).count())


def rank_sql(edges: str, vertices: str, steps: int, sink: int | None, by_out_degree: bool = False) -> str:
    """Ranks after ``steps`` steps as one query, two common table expressions a step."""
    is_sink = "FALSE" if sink is None else f"v = {sink}"
    share = "rank / d" if by_out_degree else "rank"
    parts = [
        f"e AS MATERIALIZED ({edges})",
        f"vs AS MATERIALIZED ({vertices})",
        "deg AS MATERIALIZED (SELECT src AS u, count(*) AS d FROM e GROUP BY src)",
        f"n AS MATERIALIZED (SELECT CAST(count(*) AS DOUBLE) AS n FROM vs WHERE NOT ({is_sink}))",
        f"r0 AS MATERIALIZED (SELECT v, CASE WHEN {is_sink} THEN CAST(0 AS DOUBLE) "
        "ELSE 1 / (SELECT n FROM n) END AS rank FROM vs)",
    ]
    for step in range(1, steps + 1):
        spread = ["CAST(0 AS DOUBLE)"]
        if sink is not None:
            spread.append(f"(SELECT coalesce(sum(inc), 0) FROM i{step} WHERE dst = {sink})")
        if by_out_degree:
            spread.append(f"(SELECT coalesce(sum(rank), 0) FROM r{step - 1} "
                          f"WHERE NOT ({is_sink}) AND v NOT IN (SELECT u FROM deg))")
        parts += [
            f"i{step} AS MATERIALIZED (SELECT dst, sum({share}) AS inc "
            f"FROM e JOIN r{step - 1} ON src = v JOIN deg ON src = u GROUP BY dst)",
            f"r{step} AS MATERIALIZED (SELECT v, CASE WHEN {is_sink} THEN CAST(0 AS DOUBLE) "
            f"ELSE coalesce(inc, 0) + ({' + '.join(spread)}) / (SELECT n FROM n) END AS rank "
            f"FROM vs LEFT JOIN i{step} ON v = dst)",
        ]
    return f"WITH {', '.join(parts)} SELECT v, round(rank, 12) AS rank FROM r{steps}"


def rounded(ranks: DataFrame) -> DataFrame:
    """Sums of doubles depend on their order in the last digits, so compare 12 places."""
    return ranks.select("v", F.round("rank", 12).alias("rank"))


def customers(spark, d) -> DataFrame:
    return el.table(spark, d, "customer").selectExpr("c_custkey AS v")


def suppliers(spark, d) -> DataFrame:
    return el.table(spark, d, "supplier").selectExpr("s_suppkey AS v")


@query("incoming_rank", over(FOLLOWS, """
SELECT dst AS v, round(sum(CAST(1 AS DOUBLE) / (SELECT count(*) FROM customer)), 12) AS inc
FROM e WHERE src IN (SELECT c_custkey FROM customer) GROUP BY dst"""))
def incoming_rank(spark, d):
    users = customers(spark, d)
    ranks = el.initial_ranks(users, users.count(), sink=None)
    return el.incoming_rank(el.follows(spark, d), ranks).select("v", F.round("inc", 12).alias("inc"))


@query("pagerank_step", rank_sql(FOLLOWS, CUSTOMERS, 1, 0))
def pagerank_step(spark, d):
    users = customers(spark, d)
    n = users.count() - 1
    return rounded(el.pagerank_step(el.follows(spark, d), users, el.initial_ranks(users, n), n, sink=0))


@query("pagerank_chain", rank_sql(CHAINS, CHAIN_VERTICES, 10, 0))
def pagerank_chain(spark, d):
    return rounded(el.pagerank(chain_graph(spark, d), chain_vertices(spark, d), 10, sink=0))


@query("pagerank_sink", rank_sql(FOLLOWS, CUSTOMERS, 3, 0))
def pagerank_sink(spark, d):
    return rounded(el.pagerank(el.follows(spark, d), customers(spark, d), 3, sink=0))


@query("pagerank_out_degree", rank_sql(FOLLOWS, CUSTOMERS, 3, None, True))
def pagerank_out_degree(spark, d):
    return rounded(el.pagerank(el.follows(spark, d), customers(spark, d), 3, normalize="out_degree"))


@query("pagerank_dense_out_degree", rank_sql(DENSE, SUPPLIERS, 3, 0, True))
def pagerank_dense_out_degree(spark, d):
    return rounded(el.pagerank(
        el.follows_dense(spark, d), suppliers(spark, d), 3, sink=0, normalize="out_degree"))


@query("pagerank_out_degree_skewed", rank_sql(SKEWED, CUSTOMERS, 3, None, True))
def pagerank_out_degree_skewed(spark, d):
    return rounded(el.pagerank(el.follows_skewed(spark, d), customers(spark, d), 3, normalize="out_degree", rows_per_part=4))


@query("pagerank_start_ranks", over(FOLLOWS, """
, n AS (SELECT CAST(count(*) AS DOUBLE) AS n FROM customer),
i AS (SELECT dst, sum((src % 7 + 1) / (SELECT n FROM n)) AS inc FROM e GROUP BY dst)
SELECT c_custkey // 2 AS v, round(coalesce(any_value(inc), 0), 12) AS rank
FROM customer LEFT JOIN i ON dst = c_custkey // 2 GROUP BY c_custkey // 2"""))
def pagerank_start_ranks(spark, d):
    # ranks of all users, vertices only the lower half of them
    users = customers(spark, d)
    n = users.count()
    ranks = users.selectExpr("v", f"(v % 7 + 1) / {n}D AS rank")
    half = users.selectExpr("v div 2 AS v").distinct()
    return rounded(el.pagerank(el.follows(spark, d), half, 1, ranks=ranks))


@query("pagerank_text_ids", f"SELECT CAST(v AS VARCHAR) AS v, rank FROM ({rank_sql(FOLLOWS, CUSTOMERS, 2, 0)})")
def pagerank_text_ids(spark, d):
    edges = el.parse_edges(el.format_pairs(el.follows(spark, d)), id_type="string")
    users = el.parse_vertices(customers(spark, d).selectExpr("concat(v, ',0') AS value"), id_type="string")
    return rounded(el.pagerank(edges, users, 2, sink="0"))


# --- text files -----------------------------------------------------------------------


@query("read_edges_roundtrip", over(FOLLOWS, "SELECT src, dst FROM e"))
def read_edges_roundtrip(spark, d):
    path = scratch_path(spark, "edges")
    el.write_pairs(el.follows(spark, d), path)
    return el.read_edges(spark, path)


@query("parse_edges_many_per_line", over(FOLLOWS, """
SELECT src, dst FROM e UNION ALL SELECT dst, src FROM e UNION ALL SELECT src, src FROM e"""))
def parse_edges_many_per_line(spark, d):
    lines = el.follows(spark, d).selectExpr("format_string('%d,%d  %d,%d,%d,%d', src, dst, dst, src, src, src) AS value")
    return el.parse_edges(lines)


@query("parse_edges_drop", over(FOLLOWS, """
SELECT src, dst FROM e WHERE src <= dst UNION ALL SELECT dst, src FROM e WHERE src = dst"""))
def parse_edges_drop(spark, d):
    lines = el.follows(spark, d).selectExpr("""
        CASE WHEN src < dst THEN format_string('%d,%d x,%d', src, dst, src)
             WHEN src = dst THEN format_string('%d,%d,%d,%d 7', src, dst, dst, src)
             ELSE format_string('%d,%d,%d', src, dst, src) END AS value""")
    return el.parse_edges(lines, mode="drop")


@query("write_pairs_roundtrip", over(FOLLOWS, """
SELECT CAST(dst AS VARCHAR) || ',' || CAST(count(*) AS VARCHAR) AS value FROM e GROUP BY dst"""))
def write_pairs_roundtrip(spark, d):
    path = scratch_path(spark, "followers")
    el.write_pairs(follower_count(spark, d), path, sort_keys=True)
    return spark.read.text(path)


@query("write_tuples_roundtrip", over(FOLLOWS, """
SELECT '(' || CAST(dst AS VARCHAR) || ',' || CAST(count(*) AS VARCHAR) || ')' AS value FROM e GROUP BY dst"""))
def write_tuples_roundtrip(spark, d):
    path = scratch_path(spark, "followers")
    el.write_pairs(follower_count(spark, d), path, style="tuple")
    return spark.read.text(path)


@query("write_csv_roundtrip", over(FOLLOWS, """
SELECT CAST(dst AS VARCHAR) || ':' || CAST(count(*) AS VARCHAR) AS value FROM e GROUP BY dst"""))
def write_csv_roundtrip(spark, d):
    path = scratch_path(spark, "followers")
    el.write_pairs(follower_count(spark, d), path, sep=":", style="csv")
    return spark.read.text(path)


@query("read_ranks_roundtrip", ORACLES["initial_ranks"])
def read_ranks_roundtrip(spark, d):
    path = scratch_path(spark, "ranks")
    el.write_pairs(initial_ranks(spark, d), path)
    return el.read_ranks(spark, path)


@query("read_vertices_roundtrip", CHAIN_VERTICES)
def read_vertices_roundtrip(spark, d):
    path = scratch_path(spark, "vertices")
    el.write_pairs(chain_vertices(spark, d).selectExpr("v", "0 AS unused"), path)
    return el.read_vertices(spark, path)


@query("read_ranks_many_per_line", f"SELECT v, rank FROM ({ORACLES['initial_ranks']}) UNION ALL SELECT v + 1, 0.5 FROM ({CHAIN_VERTICES})")
def read_ranks_many_per_line(spark, d):
    return el.parse_ranks(initial_ranks(spark, d).selectExpr("concat(v, ',', rank, '  ', v + 1, ',0.5') AS value"))


@query("read_ranks_drop", f"SELECT v, CAST(0.5 AS DOUBLE) AS rank FROM ({CHAIN_VERTICES})")
def read_ranks_drop(spark, d):
    lines = chain_vertices(spark, d).selectExpr("concat(v, ', ,0.25 x,1 ', v, ',0.5 ', v, ',z 7') AS value")
    return el.parse_ranks(lines, mode="drop")


@query("read_vertices_many_per_line", f"SELECT v FROM ({CHAIN_VERTICES}) UNION ALL SELECT v + 1 FROM ({CHAIN_VERTICES})")
def read_vertices_many_per_line(spark, d):
    return el.parse_vertices(chain_vertices(spark, d).selectExpr("concat(v, ',0 ', v + 1, ',0') AS value"))
