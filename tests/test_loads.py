from __future__ import annotations

import time

import pytest
from pyspark.sql import functions as F

from lakeops.operators.numbering import with_page
from lakeops.plans import jobs, replay
from lakeops.sources import files


def slow(spark, seconds):
    """A job of two tasks that take so long."""
    rest = F.udf(lambda i: time.sleep(seconds) or i, "long")
    return spark.range(2, numPartitions=2).select(rest("id").alias("id")).agg(F.sum("id")).first()[0]


def test_slow_table_is_stopped_and_the_others_finish(spark):
    def load(name):
        if name == "slow":
            slow(spark, 40)
        return spark.range(100).count()

    started = time.monotonic()
    with pytest.raises(jobs.LoadError) as caught:
        jobs.run_tables(spark, ["a", "slow", "b"], load, workers=3, seconds=8)
    assert time.monotonic() - started < 35
    assert set(caught.value.errors) == {"slow"} and isinstance(caught.value.errors["slow"], TimeoutError)
    status = {r["table_name"]: r for r in caught.value.status.collect()}
    assert status["a"]["succeeded"] and status["b"]["succeeded"] and status["b"]["result"] == "100"
    assert not status["slow"]["succeeded"] and "8 seconds" in status["slow"]["error"]


def test_time_limit_stops_later_jobs_too_and_leaves_other_tables_alone(spark):
    def load(name):
        for _ in range(30):
            try:
                slow(spark, 0.5)
            except Exception:
                continue  # a load that goes on after a cancelled job
        return name

    with pytest.raises(jobs.LoadError) as caught:
        jobs.run_tables(spark, ["many"], load, seconds=4)
    assert "4 seconds" in str(caught.value.errors["many"])
    assert not list(spark.sparkContext.getJobTags())
    status = jobs.run_tables(spark, ["x"], lambda name: spark.range(3).count(), seconds=60)
    assert status.first()["succeeded"]


def paged(spark, count, size):
    messages = spark.range(count).select(
        F.col("id").cast("string").alias("key"), F.concat(F.lit("v"), "id").alias("value"), "id"
    )
    return with_page(messages, ["id"], size).drop("id")


def test_failed_page_is_sent_again_alone(spark, path, rows):
    hand_over = replay.Replay(spark, f"{path}/replay")
    hand_over.prepare(paged(spark, 45, 10))
    store, sent, failing = replay.folder_sink(f"{path}/out"), [], {2}

    def sink(page_rows, page):
        sent.append(page)
        store(page_rows.limit(3) if page in failing else page_rows, page)  # half a page
        if page in failing:
            raise ConnectionError("gone")

    with pytest.raises(ConnectionError):
        hand_over.send(sink, attempts=2)
    assert sent == [0, 1, 2, 2] and hand_over.sent() == [0, 1] and hand_over.waiting() == [2, 3, 4]
    failing.clear()
    assert hand_over.send(sink) == 3 and sent[4:] == [2, 3, 4]
    assert hand_over.send(sink) == 0
    out = spark.read.parquet(f"{path}/out")
    assert rows(out, "key") == sorted((str(i),) for i in range(45))
    assert out.where("page = 2").count() == 10


def test_pages_go_to_a_batch_sink(spark, path, rows):
    hand_over = replay.Replay(spark, f"{path}/replay")
    hand_over.prepare(paged(spark, 7, 3))
    assert hand_over.send(replay.broker_sink({"path": f"{path}/topic"}, "json")) == 3
    assert rows(spark.read.json(f"{path}/topic"), "key", "value") == [(str(i), f"v{i}") for i in range(7)]


def write_lines(spark, path, lines):
    spark.createDataFrame([(line,) for line in lines], "value string").coalesce(1).write.text(path)


def test_responses_of_unknown_shape(spark, path, rows):
    lines = [
        '{"items": [{"id": 1, "owner": {"name": "a"}}, {"id": "two", "tags": ["x"]}], "has_more": true}',
        '{"items": [], "quota": 5}',
        '{"error": "throttle"}',
        "",
        '{"items": [{"id": 3.5, "owner": null}]}',
    ]
    write_lines(spark, f"{path}/in", lines)
    pages = files.read_variant_pages(spark, f"{path}/in")
    assert pages.count() == 4
    items = files.variant_items(pages)
    found = files.variant_fields(items, "item", {"id": "bigint", "owner.name": "string", "tags": "array<string>"})
    assert found.columns == ["id", "name", "tags"]
    # A text that is no number is NULL, a fraction is cast.
    assert [(r["id"], r["name"], r["tags"]) for r in found.collect()] == [(1, "a", None), (None, None, ["x"]), (3, None, None)]
    shape = files.variant_schema(pages, "response")
    assert shape.startswith("STRUCT<") and "quota: BIGINT" in shape and "has_more: BOOLEAN" in shape
    # Stored and read again as it is.
    items.write.parquet(f"{path}/items")
    assert spark.read.parquet(f"{path}/items").count() == 3
    write_lines(spark, f"{path}/bad", ['{"items": [{"id": 1}, {"i'])
    with pytest.raises(Exception):
        files.read_variant_pages(spark, f"{path}/bad").collect()
