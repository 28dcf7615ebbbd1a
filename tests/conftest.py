from __future__ import annotations

import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from statforge.session import checkpoint_dir, get_session

    shared = tempfile.mkdtemp(prefix="statforge-tests-")
    conf = {"spark.checkpoint.dir": f"file://{shared}/checkpoints", "spark.sql.warehouse.dir": f"file://{shared}/warehouse"}
    s = get_session("local[4]", app_name="statforge-tests", shuffle_partitions=4, extra=conf)
    s.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(s)
    yield s
    s.stop()


@pytest.fixture()
def workdir():
    """A fresh scratch folder per test (local tests only)."""
    return tempfile.mkdtemp(prefix="statforge-test-")


def lines(spark, texts):
    """A ``DataFrame[value]`` of the given lines, in one partition (file order)."""
    return spark.createDataFrame([(t,) for t in texts], "value STRING").coalesce(1)
