import importlib
import time

import pytest
from pyspark.sql import functions as F

from edgeloom import (
    adjacency, follower_count, follows, initial_ranks, max_filter, pagerank_step, triangle_count, triangles,
    two_paths, vertices_of,
)
from edgeloom.plans import fits_broadcast, hub_table, shared_dir, stage

SF_DIR = "/root/testdata/sf0.001"


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def nodes(plan):
    """Names of the nodes of a physical plan, leaving out how kept tables were made."""
    children = plan.children()
    return [plan.nodeName()] + sum((nodes(children.apply(i)) for i in range(children.size())), [])


def degree_table(spark, degrees):
    return spark.createDataFrame(list(enumerate(degrees)), "v BIGINT, d BIGINT")


def test_hub_table_is_bounded(spark):
    degrees = [1000, 400, 300, 5, 5, 4, 3, 2, 1, 1]
    rows = spark.range(sum(degrees))
    # Ten rows at most may be kept: only degrees above a tenth of the total qualify.
    found = hub_table(degree_table(spark, degrees), rows, 1, 0, max_rows=10).collect()
    assert sorted(r.v for r in found) == [0, 1, 2]
    found = hub_table(degree_table(spark, degrees), rows, 1, 350, max_rows=10).collect()
    assert sorted(r.v for r in found) == [0, 1]
    assert {r.part_rows for r in found} == {350}


def test_hub_table_never_exceeds_its_bound(spark):
    degrees = [7] * 50
    for max_rows in (19, 30, 50, 60):
        bound = max(max_rows, sum(degrees) ** 0.5)
        assert hub_table(degree_table(spark, degrees), spark.range(350), 1, 0, max_rows).count() <= bound


def test_filter_and_columns_reach_the_scan(spark):
    plan = plan_of(max_filter(follows(spark, SF_DIR), 10))
    assert "LessThan(o_custkey,10)" in plan
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint>" in plan


def test_counts_are_partial_before_the_shuffle(spark):
    plan = plan_of(follower_count(follows(spark, SF_DIR)))
    assert plan.index("Exchange") < plan.index("partial_count")


def test_no_join_without_keys_and_no_python(spark):
    graph = follows(spark, SF_DIR)
    for df in (triangle_count(graph, "all", "shuffle"), two_paths(graph, "shuffle")):
        plan = plan_of(df)
        assert "SortMergeJoin" in plan
        for word in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "Pandas"):
            assert word not in plan


def test_a_step_shuffles_ranks_and_sums_but_not_links(spark, monkeypatch):
    module = importlib.import_module("edgeloom.operators.pagerank")
    steps = []

    def watched(df, name):
        steps.append(nodes(df._jdf.queryExecution().executedPlan().initialPlan()))
        return stage(df, name)

    monkeypatch.setattr(module, "stage", watched)
    graph = follows(spark, SF_DIR)
    small = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)  # as if the ranks were many
    try:
        module.pagerank(graph, vertices_of(graph), 3, normalize="out_degree")
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", small)
    for names in steps[1:]:
        assert names.count("Exchange") == 2, names
        assert names.count("InMemoryTableScan") == 2  # links and vertices
        assert names.count("Scan parquet ") == 1  # the written table of the step before


def rows_read(spark, run):
    """Input rows of all tasks that ``run`` starts."""
    sc, jvm = spark.sparkContext, spark.sparkContext._jvm

    def stages():
        found = sc._jsc.sc().statusStore().stageList(
            jvm.java.util.ArrayList(), False, False, sc._gateway.new_array(jvm.double, 0), jvm.java.util.ArrayList())
        return [(found.apply(i).stageId(), found.apply(i).inputRecords()) for i in range(found.size())]

    last = max((number for number, _ in stages()), default=-1)
    run()
    time.sleep(1.0)  # the store is filled by a listener
    return sum(rows for number, rows in stages() if number > last)


def test_edges_are_scanned_once(spark):
    graph = follows(spark, SF_DIR)
    users = spark.read.parquet(f"{SF_DIR}/customer.parquet").selectExpr("c_custkey AS v")
    users_read = 2 * 150  # the number of users is part of the plan
    assert 1500 <= rows_read(spark, lambda: triangle_count(graph).collect()) <= 1500 + users_read
    # a broadcast is preceded by a count of the folded pairs
    twice = rows_read(spark, lambda: triangle_count(graph, strategy="broadcast").collect())
    assert 3000 <= twice <= 3000 + 2 * users_read
    for run in (lambda: triangle_count(graph, "all", "shuffle"), lambda: triangles(graph), lambda: two_paths(graph),
                lambda: adjacency(graph)):
        assert 1500 <= rows_read(spark, lambda: run().collect()) <= 1500 + users_read
    ranks = initial_ranks(users, 150)
    assert rows_read(
        spark, lambda: pagerank_step(graph, users, ranks, 150, 0, "out_degree").collect()) <= 1500 + 6 * 150


def test_stage_cuts_the_plan(spark):
    made = stage(spark.range(10).withColumn("x", F.col("id") * 2), "t")
    assert "Range" not in plan_of(made)
    assert made.agg(F.sum("x")).first()[0] == 90
    assert made._jdf.inputFiles()[0].replace("file://", "").startswith(shared_dir(spark).replace("file://", ""))


class FakeSession:
    """Stands in for sessions with other settings; those of a running one are fixed."""

    def __init__(self, configured, set_later, master):
        self.conf = self.sparkContext = self
        self.configured, self.set_later, self.master = configured, set_later, master

    def get(self, key, default):
        return self.configured if key == "spark.checkpoint.dir" else default

    def getCheckpointDir(self):
        return self.set_later

    def setCheckpointDir(self, folder):
        self.set_later = folder


def test_shared_dir_follows_the_session(spark):
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        assert shared_dir(spark) == configured
    assert shared_dir(FakeSession("hdfs:///shared/", "hdfs:///other", "yarn")) == "hdfs:///shared"
    assert shared_dir(FakeSession(None, "hdfs:///other", "yarn")) == "hdfs:///other"
    assert "edgeloom-" in shared_dir(FakeSession(None, None, "local[8]"))
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_dir(FakeSession(None, None, "local-cluster[3,2,1024]"))
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_dir(FakeSession(None, None, "yarn"))


@pytest.mark.parametrize("rows, fits", [(5, True), (6, False)])
def test_fits_broadcast(spark, rows, fits):
    assert fits_broadcast(spark.range(rows), 5) is fits
