from __future__ import annotations

import uuid

import pytest
from pyspark.sql import functions as F

from lakeops.operators import merge
from lakeops.tables.bucketed import BucketedTable

SCHEMA = "k long, v string"


@pytest.fixture
def name():
    return f"bucketed_{uuid.uuid4().hex[:8]}"


@pytest.fixture
def no_broadcast(spark):
    keys = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.legacy.bucketedTableScan.outputOrdering": "true"}
    before = {k: spark.conf.get(k) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def extract(spark, rows, changed):
    value = F.when(F.col("id") % changed == 0, "new").otherwise("old")
    return spark.range(rows).select(F.col("id").alias("k"), value.alias("v"))


def below(plan, word, stops=("Exchange",)):
    """Lines of the plan from each scan of a table up to its join."""
    return [line for line in plan.split("\n") if word in line]


@pytest.mark.parametrize("buckets", [3, 8])
def test_target_is_neither_shuffled_nor_sorted(spark, name, rows, no_broadcast, buckets):
    table = BucketedTable(spark, name, ["k"], buckets)
    first, second = extract(spark, 2_000, 7), extract(spark, 1_500, 5)
    table.sync(first)
    planned = table.sync_plan(second)
    plan = planned._jdf.queryExecution().executedPlan().toString()
    # The only shuffle is the source's, into the buckets; the only sorts are the source's.
    assert plan.count("Exchange") == 1 and f"hashpartitioning(k" in plan and f", {buckets})" in plan
    scan = plan[plan.index("FileScan parquet") - 600 :]
    assert "Bucketed: true" in plan and "Sort" not in scan.split("FileScan parquet")[0].rsplit("SortMergeJoin", 1)[0][-1:]
    target_side = [line for line in plan.split("\n") if "FileScan" in line or "Sort [" in line]
    assert sum("Sort [" in line for line in target_side) <= 2
    expected = merge.sync(first.withColumn(merge.DELETED, F.lit(False)), second, ["k"])
    assert rows(planned) == rows(expected)
    table.sync(second)
    assert rows(spark.table(name)) == rows(expected)


def test_loads_keep_two_generations(spark, name, rows):
    table = BucketedTable(spark, name, ["k"], 4)
    frame = lambda *r: spark.createDataFrame(list(r), SCHEMA)
    table.sync(frame((1, "a"), (2, "b")))
    table.sync(frame((1, "a"), (3, "c")))
    table.merge(frame((3, "d"), (4, "e")).withColumn(merge.DELETED, F.lit(False)))
    assert rows(table.read()) == [(1, "a", False), (2, "b", True), (3, "d", False), (4, "e", False)]
    assert table._generations() == [1, 2]
    with pytest.raises(ValueError, match="exists already"):
        table.create(frame((1, "a")))
    with pytest.raises(Exception, match="(?i)key"):
        table.sync(frame((1, "a"), (1, "b")))
    assert table._generations() == [1, 2]
