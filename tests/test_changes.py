from __future__ import annotations

from datetime import datetime

from lakeops.operators import changes

WHEN = datetime(2022, 1, 2, 3, 4, 5)


def test_images_of_a_commit(spark, rows):
    before = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "k int, v string")
    after = spark.createDataFrame([(1, "a"), (3, "c"), (4, "d")], "k int, v string")
    feed = changes.change_rows(before, after, ["k"], 7, WHEN)
    assert rows(feed.drop(changes.COMMIT_TIME)) == [
        (2, "b", "delete", 7), (3, None, "update_preimage", 7),
        (3, "c", "update_postimage", 7), (4, "d", "insert", 7),
    ]
    assert feed.first()[changes.COMMIT_TIME] == WHEN


def test_latest_change_ignores_preimages(spark, rows):
    feed = spark.createDataFrame(
        [(1, "a", "insert", 0), (1, "a", "update_preimage", 5), (1, "b", "update_postimage", 4),
         (2, "x", "insert", 1), (2, "x", "delete", 2)],
        "k int, v string, _change_type string, _commit_version long")
    assert rows(changes.latest_changes(feed, ["k"])) == [
        (1, "b", "update_postimage", 4), (2, "x", "delete", 2)]
    assert rows(changes.replayed(feed, ["k"])) == [(1, "b")]


def test_latest_change_limits_groups_before_the_shuffle(spark):
    """A key which fills the feed sends one row per task."""
    feed = spark.range(1000).selectExpr("id % 3 AS k", "id AS _commit_version", "'insert' AS _change_type")
    plan = changes.latest_changes(feed, ["k"])._jdf.queryExecution().executedPlan().toString()
    assert plan.index("WindowGroupLimit") < plan.rindex("Exchange") < plan.rindex("WindowGroupLimit")


def test_start_is_included(spark):
    feed = spark.createDataFrame([(v, datetime(2022, 1, v)) for v in (1, 2, 3)],
                                 "_commit_version long, _commit_timestamp timestamp")
    assert changes.from_version(feed, 2).count() == 2
    assert changes.from_time(feed, datetime(2022, 1, 2)).count() == 2


def test_an_insert_wins_over_a_delete_of_the_same_overwrite(spark, rows):
    feed = [(k, kind, 1) for k in range(50) for kind in ("delete", "insert")] + [(99, "delete", 1)]
    for order in (feed, feed[::-1]):
        frame = spark.createDataFrame(order, "k int, _change_type string, _commit_version long").repartition(7)
        assert {r["k"] for r in changes.replayed(frame, ["k"]).collect()} == set(range(50))
