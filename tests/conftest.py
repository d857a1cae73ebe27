import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from edgeloom.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, "edgeloom-tests")
    session.conf.set("spark.sql.shuffle.partitions", "4")
    yield session
    session.stop()


@pytest.fixture
def edges(spark):
    def make(pairs):
        return spark.createDataFrame(list(pairs), "src BIGINT, dst BIGINT")

    return make
