import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tests")]

from teampulse.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, "tests")
    session.conf.set("spark.sql.shuffle.partitions", "4")
    yield session
    session.stop()


@pytest.fixture
def one(spark):
    """Evaluate column expressions on one row given as keyword arguments."""

    def run(schema: str, row: tuple, *cols):
        return tuple(spark.createDataFrame([row], schema).select(*cols).head())

    return run
