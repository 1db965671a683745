from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from lakeops.session import local_session, scratch_path  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session("4", shuffle_partitions=4)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def path(spark):
    return scratch_path(spark, "test")


@pytest.fixture
def rows():
    """The rows of a DataFrame as a sorted list of tuples."""

    def listed(df, *columns):
        df = df.select(*columns) if columns else df
        return sorted((tuple(r) for r in df.collect()), key=lambda r: tuple(map(str, r)))

    return listed
