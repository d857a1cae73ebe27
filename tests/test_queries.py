import pytest

from __spark_entry__ import entry, oracle_sql, queries
from compare import connect, mismatch

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", oracle_sql())
def test_query_gives_the_rows_of_its_sql(spark, con, name):
    assert mismatch(queries()[name](spark, SF_DIR), con, oracle_sql()[name]) == ""


def test_every_graph_query_has_its_sql():
    assert {name for name in queries() if not name.startswith("op") and name != "pipeline"} <= set(oracle_sql())


def test_entry(spark):
    assert entry(spark).collect()[0].triangles == 293
