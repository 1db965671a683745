from __future__ import annotations

from pyspark.sql import functions as F

from lakeops.operators import numbering


def test_numbers_are_dense_and_in_order(spark):
    frame = spark.range(5000).select((F.col("id") * 7919 % 5000).alias("k"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    numbered = numbering.with_row_number(frame, ["k"])
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert numbered.rdd.getNumPartitions() > 1
    found = numbered.collect()
    assert sorted(r["row_number"] for r in found) == list(range(1, 5001))
    assert all(r["row_number"] == r["k"] + 1 for r in found)


def test_numbers_survive_union_and_filters(spark, rows):
    frame = spark.range(100).select(F.col("id").alias("k"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    numbered = numbering.with_row_number(frame, ["k"], "n", 0)
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    other = spark.range(1000, 1100).select(F.col("id").alias("k"), F.col("id").alias("n"))
    both = other.unionByName(numbered).where("k % 2 = 1")
    assert both.where("k != n").count() == 0 and both.count() == 100


def test_no_rows(spark):
    assert numbering.with_row_number(spark.range(0), ["id"]).count() == 0


def test_ids_go_on_after_the_highest(spark, rows):
    new = spark.createDataFrame([("b",), ("a",)], "code string")
    assert rows(numbering.assign_ids(new, "id", ["code"], 41)) == [(42, "a"), (43, "b")]
    known = spark.createDataFrame([(5,), (9,)], "id long")
    assert numbering.highest_id(known, "id") == 9
    assert numbering.highest_id(known.limit(0), "id") == 0


def test_pages_forward_without_loss_at_ties(spark):
    frame = spark.range(95).select((F.col("id") / 40).cast("int").alias("ts"), "id")
    order = ["ts", "id"]
    pages = {r["id"]: r["page"] for r in numbering.with_page(frame, order, 10).collect()}
    assert pages == {i: i // 10 for i in range(95)}
    seen, cursor = [], None
    while True:
        page = numbering.next_page(frame, order, 10, cursor)
        cursor = numbering.page_cursor(page, order)
        if cursor is None:
            break
        seen += [r["id"] for r in page.collect()]
    assert seen == list(range(95))


def test_next_page_is_a_top_k_with_pushed_filter(spark, path):
    spark.range(100).select("id", (F.col("id") * 2).alias("ts")).write.parquet(path)
    page = numbering.next_page(spark.read.parquet(path), ["ts", "id"], 10, (50, 25))
    plan = page._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan and "GreaterThanOrEqual(ts,50)" in plan
