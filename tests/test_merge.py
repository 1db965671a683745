from __future__ import annotations

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from lakeops.functions import any_changed
from lakeops.operators import merge
from lakeops.operators.changes import change_rows, replayed

T = "k int, name string, value double, is_deleted boolean"
S = "k int, name string, value double"


def test_sync_inserts_updates_marks_and_revives(spark, rows):
    target = spark.createDataFrame(
        [(1, "same", 1.0, False), (2, "old", 2.0, False), (3, "gone", 3.0, False),
         (4, "back", 4.0, True), (5, "stays away", 5.0, True)], T)
    source = spark.createDataFrame(
        [(1, "same", 1.0), (2, "new", 2.0), (4, "back", 4.0), (6, "first", 6.0)], S)
    assert rows(merge.sync(target, source, ["k"])) == [
        (1, "same", 1.0, False), (2, "new", 2.0, False), (3, "gone", 3.0, True),
        (4, "back", 4.0, False), (5, "stays away", 5.0, True), (6, "first", 6.0, False),
    ]
    actions = {r["after"]["k"]: r["action"] for r in merge.sync_pairs(target, source, ["k"]).collect()}
    assert actions == {1: "keep", 2: "update", 3: "soft_delete", 4: "update", 5: "keep", 6: "insert"}


@pytest.mark.parametrize("null_safe, expected", [(True, None), (False, "x")])
def test_change_to_null_needs_null_safe_comparison(spark, null_safe, expected):
    target = spark.createDataFrame([(1, "x", 1.0, False)], T)
    source = spark.createDataFrame([(1, None, 1.0)], S)
    synced = merge.sync(target, source, ["k"], null_safe=null_safe)
    assert synced.first()["name"] == expected


def test_nan_is_not_a_change(spark):
    target = spark.createDataFrame([(1, "x", float("nan"), False)], T)
    source = spark.createDataFrame([(1, "x", float("nan"))], S)
    assert merge.sync_pairs(target, source, ["k"]).first()["action"] == "keep"


def test_column_named_inside_the_key_is_compared(spark):
    """``area`` is part of the text ``area_code`` but no key."""
    target = spark.createDataFrame([("A1", "north", False)], "area_code string, area string, is_deleted boolean")
    source = spark.createDataFrame([("A1", "south")], "area_code string, area string")
    assert merge.sync(target, source, ["area_code"]).first()["area"] == "south"


def test_source_columns_may_come_in_another_order(spark):
    target = spark.createDataFrame([(1, "a", "b", False)], "k int, x string, y string, is_deleted boolean")
    source = spark.createDataFrame([("b", "a", 1)], "y string, x string, k int")
    assert merge.sync_pairs(target, source, ["k"]).first()["action"] == "keep"


@pytest.mark.parametrize("keys, message", [([(1,), (1,)], "several source rows"), ([(None,)], "NULL in merge key")])
@pytest.mark.parametrize("whole", [True, False])
def test_bad_source_keys_fail(spark, keys, message, whole):
    target = spark.createDataFrame([(1, "x")], "k int, v string")
    source = spark.createDataFrame(keys, "k int").withColumn("v", F.lit("y"))
    with pytest.raises(Exception, match=message):
        merge.merge(target, source, ["k"], whole_target=whole).collect()


def test_null_in_one_part_of_a_key_fails(spark):
    frame = spark.createDataFrame([(1, None)], "a int, b int")
    with pytest.raises(Exception, match="NULL in merge key"):
        merge.unique_keys(frame, ["a", "b"]).collect()


def test_merge_branches_and_expressions(spark, rows):
    target = spark.createDataFrame([("FR", 0.5), ("DE", 0.1)], "country string, rate double")
    source = spark.createDataFrame(
        [("FR", 6.0, 10.0, "update_postimage"), ("DE", 9.0, 10.0, "update_preimage"),
         ("IT", 1.0, 4.0, "insert")],
        "country string, vaccinated double, doses double, kind string")
    rate = "s.vaccinated / s.doses"
    merged = merge.merge(
        target, source, ["country"], update={"rate": rate}, when="s.kind = 'update_postimage'",
        insert={"country": "s.country", "rate": rate})
    assert rows(merged) == [("DE", 0.1), ("FR", 0.6), ("IT", 0.25)]
    only_update = merge.merge(target, source, ["country"], update={"rate": rate}, insert={})
    assert rows(only_update) == [("DE", 0.9), ("FR", 0.6)]
    no_insert = merge.merge(
        target, source, ["country"], update={}, insert={"country": "s.country"}, insert_when="s.doses > 5")
    assert rows(no_insert) == [("DE", 0.1), ("FR", 0.5)]


def test_partial_pairs_leave_other_target_rows_out(spark, rows):
    target = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    source = spark.createDataFrame([(2, "B"), (3, "C")], "k int, v string")
    pairs = merge.merge_pairs(target, source, ["k"], whole_target=False)
    assert rows(pairs.select("action", "after.k", "after.v")) == [("insert", 3, "C"), ("update", 2, "B")]


def test_soft_deletes_skip_inactive_rows(spark, rows):
    target = spark.createDataFrame([(1, False), (2, True), (3, None)], "k int, is_deleted boolean")
    source = spark.createDataFrame([(9,)], "k int")
    assert rows(merge.soft_deletes(target, source, ["k"])) == [(1, True)]


def test_sync_needs_the_same_columns(spark):
    target = spark.createDataFrame([(1, "x", 1.0, False)], T)
    with pytest.raises(ValueError, match="extra"):
        merge.sync(target, spark.createDataFrame([(1, "x", 1.0, 2)], S + ", extra int"), ["k"])


def test_any_changed_without_columns_is_false(spark):
    assert spark.range(1).where(any_changed([])).count() == 0


KEYED = st.dictionaries(
    st.integers(0, 6), st.tuples(st.sampled_from(["a", "b", None]), st.sampled_from([1.0, 2.0])), max_size=6)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(before=KEYED, extract=KEYED, deleted=st.sets(st.integers(0, 6)))
def test_sync_against_plain_python(spark, before, extract, deleted):
    target = spark.createDataFrame([(k, *v, k in deleted) for k, v in before.items()], T)
    source = spark.createDataFrame([(k, *v) for k, v in extract.items()], S)
    expected = {k: (*v, True) for k, v in before.items()} | {k: (*v, False) for k, v in extract.items()}
    synced = merge.sync(target, source, ["k"])
    assert {r[0]: tuple(r)[1:] for r in synced.collect()} == expected
    again = merge.sync_pairs(synced, source, ["k"])
    assert again.where("action != 'keep'").count() == 0


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(before=KEYED, after=KEYED)
def test_feed_rebuilds_the_state(spark, before, after):
    from datetime import datetime

    frames = [spark.createDataFrame([(k, *v) for k, v in state.items()], S) for state in (before, after)]
    empty = spark.createDataFrame([], S)
    when = datetime(2022, 1, 1)
    feed = change_rows(empty, frames[0], ["k"], 0, when).unionByName(
        change_rows(frames[0], frames[1], ["k"], 1, when))
    assert {r[0]: tuple(r)[1:] for r in replayed(feed, ["k"]).collect()} == after


def test_keys_travel_once(spark):
    df = spark.createDataFrame([("a", 1.0)], "k string, v double")
    pairs = merge.sync_pairs(df.withColumn("is_deleted", F.lit(False)), df, ["k"])
    plan = pairs._jdf.queryExecution().optimizedPlan().toString()
    # Structs, which hold the keys once more, are made behind the join.
    assert "struct(" in plan and "struct(" not in plan[plan.index("Join") :]
