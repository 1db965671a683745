from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from lakeops.operators import relate
from lakeops.streaming import lifecycle, posts

SCHEMA = "_Id long, _OwnerUserId long"


def send(spark, path, *ids_and_owners):
    values = [(f'{{"_Id": {i}, "_OwnerUserId": {o}}}',) for i, o in ids_and_owners]
    spark.createDataFrame(values, "text string").select(
        F.lit("t").alias("topic"), F.lit(0).alias("partition"), F.lit(0).cast("long").alias("offset"),
        F.current_timestamp().alias("timestamp"), F.lit(0).alias("timestampType"),
        F.lit("k").cast("binary").alias("key"), F.col("text").cast("binary").alias("value"),
    ).write.mode("append").parquet(path)


def users(spark, *rows):
    return spark.createDataFrame(list(rows), "user_id long, display_name string")


def stream(spark, path):
    return posts.parse_posts(posts.envelope(posts.read_messages(spark, {}, "parquet", path)), SCHEMA)


def test_restart_goes_on_where_it_stopped(spark, path, rows):
    known = users(spark, (1, "one"))
    for batch in [(10, 1)], [(11, 2)]:
        send(spark, f"{path}/in", *batch)
        run = posts.append_stream(
            posts.with_users(stream(spark, f"{path}/in"), known), f"{path}/out", f"{path}/offsets", once=True)
        run.awaitTermination()
    assert rows(spark.read.parquet(f"{path}/out"), "_Id", "display_name") == [(10, "one"), (11, None)]


def test_fresh_users_are_seen_by_later_batches(spark, path, rows):
    known = [(1, "one")]
    for batch in [(10, 2)], [(11, 2)]:
        send(spark, f"{path}/in", *batch)
        run = posts.append_with_fresh_users(
            stream(spark, f"{path}/in"), lambda: users(spark, *known), f"{path}/out", f"{path}/offsets",
            once=True)
        run.awaitTermination()
        known.append((2, "two"))
    assert rows(spark.read.parquet(f"{path}/out"), "_Id", "display_name") == [(10, None), (11, "two")]


def test_full_post_schema_parses(spark):
    message = spark.createDataFrame(
        [('{"_Id": 5, "_Tags": "<x>", "_CreationDate": "2022-06-01T10:00:00.000Z"}',)], "value string")
    row = posts.parse_posts(message).first()
    assert len(row) == 22 and row["_Id"] == 5 and row["_CreationDate"].year == 2022


def test_topic_options():
    options = posts.topic_options("host:1", "posts", "g1", **{"kafka.sasl.mechanism": "PLAIN"})
    assert options["subscribe"] == "posts" and options["startingOffsets"] == "earliest"
    assert options["failOnDataLoss"] == "false" and options["kafka.sasl.mechanism"] == "PLAIN"


def exchanges(plan):
    """The shuffles of a plan, each as the text of what is below it."""
    found, lines = [], plan.split("\n")
    depth = lambda line: len(line) - len(line.lstrip(" :+-*()0123456789"))
    for n, line in enumerate(lines):
        if "Exchange hashpartitioning" in line:
            below = []
            for other in lines[n + 1 :]:
                if depth(other) <= depth(line):
                    break
                below.append(other)
            found.append((line, "\n".join(below)))
    return found


def test_rows_without_owner_cross_no_exchange(spark, rows):
    posts_rows = spark.range(3_000).select(
        F.col("id").alias("_Id"), F.when(F.col("id") % 3 == 0, F.col("id") % 7).alias("_OwnerUserId")
    )
    known = users(spark, (0, "zero"), (1, "one"), (None, "nobody"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        joined = posts.with_users(posts_rows, known)
        found = [below for line, below in exchanges(joined._jdf.queryExecution().executedPlan().toString()) if "_OwnerUserId" in line]
        expected = posts_rows.join(known, F.col("_OwnerUserId") == F.col("user_id"), "left")
        assert rows(joined) == rows(expected)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    # One shuffle of posts by their owner, of rows with an owner only.
    assert len(found) == 1 and "isnotnull" in found[0].lower()


def test_left_join_known_keeps_rows_and_names(spark, rows):
    left = spark.createDataFrame([(1, "a"), (None, "b"), (3, "c"), (1, "d")], "k long, name string")
    right = spark.createDataFrame([(1, "x"), (1, "y"), (None, "z")], "r long, name string")
    joined = relate.left_join_known(left, right, left["k"], right["r"])
    assert joined.columns == ["k", "name", "r", "name"]
    assert rows(joined) == rows(left.join(right, left["k"] == right["r"], "left"))
    assert rows(relate.left_join_known(left.limit(0), right, F.col("k"), F.col("r"))) == []


def letters(spark, path, *values):
    spark.createDataFrame([(v,) for v in values], "text string").select(
        F.lit("t").alias("topic"), F.lit(0).alias("partition"), F.lit(0).cast("long").alias("offset"),
        F.current_timestamp().alias("timestamp"), F.lit(0).alias("timestampType"),
        F.lit("k").cast("binary").alias("key"), F.col("text").cast("binary").alias("value"),
    ).write.mode("append").parquet(path)


def test_unreadable_messages_are_put_aside(spark, path, rows):
    good = ['{"_Id": 1, "_OwnerUserId": 2}', '{"_Id": 2}', '{"_Id": 3, "other": [1]}']
    bad = ["not json", "", None, "[1]", '{"_Id": "x"}', '{"_OwnerUserId": 5}', '{"_Id": 9, "_Own', "null"]
    for batch in (good[:2] + bad[:4], good[2:] + bad[4:]):
        letters(spark, f"{path}/in", *batch)
        counted = []
        messages = posts.envelope(posts.read_messages(spark, {}, "parquet", f"{path}/in"))
        posts.append_with_dead_letters(
            messages, f"{path}/out", f"{path}/dead", f"{path}/offsets", SCHEMA, "_Id", once=True,
            counts=lambda n, c: counted.append((c["readable"], c["unreadable"])),
        ).awaitTermination()
        assert counted == [(sum(x in good for x in batch), sum(x in bad for x in batch))]
    assert rows(spark.read.parquet(f"{path}/out"), "_Id", "_OwnerUserId") == [(1, 2), (2, None), (3, None)]
    dead = rows(spark.read.parquet(f"{path}/dead").select(F.col("value").cast("string").alias("text"), "reason"))
    assert sorted(map(str, bad)) == sorted(str(t) for t, _ in dead)
    reasons = dict(dead)
    assert reasons["not json"] == reasons["[1]"] == "malformed" and reasons[""] == reasons[None] == "empty"
    assert reasons['{"_OwnerUserId": 5}'] == "no _Id"


def test_timed_stream_is_watched_drained_stopped_and_started_again(spark, path, rows):
    with lifecycle.watching(spark) as watch:
        send(spark, f"{path}/in", (1, 1), (2, 1))
        run = posts.append_stream(stream(spark, f"{path}/in"), f"{path}/out", f"{path}/offsets", every="1 second")
        lifecycle.drain(run)
        send(spark, f"{path}/in", (3, 1))
        lifecycle.stop(run)
        first = watch.wait_ended(run, 30)
        assert first.ended and first.error is None and first.rows == 3 and first.batches == 2
        send(spark, f"{path}/in", (4, 1))
        again = posts.append_stream(stream(spark, f"{path}/in"), f"{path}/out", f"{path}/offsets", every="1 second")
        lifecycle.stop(again)
        assert watch.wait_ended(again, 30).rows == 1
    assert rows(spark.read.parquet(f"{path}/out"), "_Id") == [(1,), (2,), (3,), (4,)]


def test_failed_stream_is_reported(spark, path):
    send(spark, f"{path}/in", (1, 1))
    with lifecycle.watching(spark) as watch:
        failing = stream(spark, f"{path}/in").select(F.raise_error(F.lit("no luck")).alias("x"))
        run = posts.append_stream(failing, f"{path}/out", f"{path}/offsets", every="1 second")
        with pytest.raises(Exception, match="no luck"):
            lifecycle.stop(run)
        assert "no luck" in watch.wait_ended(run, 30).error
