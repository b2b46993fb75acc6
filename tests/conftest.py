import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tidemark.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(cpus=8, shuffle_partitions=4, name="tests")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def database(spark):
    """A fresh database for tables that a test writes."""
    from tidemark.plans.registered import scratch_database

    name = scratch_database(spark)
    yield name
    spark.sql(f"DROP DATABASE IF EXISTS {name} CASCADE")
