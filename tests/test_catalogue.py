"""Every registered query against its SQL, over the smallest test tables."""

from __future__ import annotations

import pytest
from compare import database, differences

import __spark_entry__ as registry
from lakeops.catalogue import QUERIES, SQL

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def views():
    return database(FOLDER)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_agrees_with_sql(spark, views, name):
    assert differences(spark, views, name, FOLDER) is None


def test_only_unspellable_queries_lack_sql():
    without = set(QUERIES) - set(SQL)
    assert without == {"table_size"}
    assert set(registry.oracle_sql()) <= set(registry.queries())


def test_entry_is_lazy_and_has_rows(spark):
    result = registry.entry(spark)
    assert "is_deleted" in result.columns
    assert result.limit(1).count() == 1
