"""Expressions, joins, profiles, readers and writers."""

from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from lakeops import functions as fn
from lakeops.operators import profile, relate
from lakeops.plans import ingest
from lakeops.plans.jobs import LoadError, run_tables
from lakeops.sources import files, jdbc, writers
from lakeops.tables import catalog


def test_tags_and_months(spark):
    posts = spark.createDataFrame(
        [("<a><b-c>", datetime(2022, 6, 30, 23, 59))], "_Tags string, _CreationDate timestamp")
    row = posts.select(fn.tag_array("_Tags").alias("t"), fn.month_start("_CreationDate").alias("m")).first()
    assert row["t"] == ["<a>", "<b-c>"] and row["m"] == "2022-06-01"


def test_bad_json_gives_nulls(spark, rows):
    frame = spark.createDataFrame([('{"a": 1, "b": "x"}',), ("no json",), (None,)], "value string")
    assert rows(fn.expand_json(frame, "value", "a long, b string")) == [(1, "x"), (None, None), (None, None)]


def test_messages_leave_null_fields_out(spark):
    frame = spark.createDataFrame([(1, None)], "id long, v string")
    assert tuple(fn.key_value_messages(frame, "id").first()) == ("1", '{"id":1}')


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz"])
def test_watermark(spark, kind):
    frame = spark.createDataFrame([(datetime(2022, 3, 1),)], f"at {kind}")
    assert fn.after_watermark(frame, "at").first()[0] == datetime(2022, 3, 1, 0, 0, 1)
    assert fn.after_watermark(frame.limit(0), "at").first()[0] == datetime(2022, 1, 1, 0, 0, 1)


def test_epoch_bounds_are_included_and_pushed(spark, path):
    spark.sql(
        "SELECT TIMESTAMP_NTZ'2021-04-23 11:43:24' + make_dt_interval(0, 0, 0, id) AS at, id FROM range(5)"
    ).write.parquet(path)
    frame = spark.read.parquet(path)
    chosen = frame.where(fn.epoch_between(frame, "at", 1619178205, 1619178207))
    assert sorted(r["id"] for r in chosen.collect()) == [1, 2, 3]
    assert "GreaterThanOrEqual(at" in chosen._jdf.queryExecution().executedPlan().toString()
    assert frame.select(fn.epoch_to_timestamp(F.lit(0)).cast("long")).first()[0] == 0


def test_series_ids(spark):
    areas = spark.createDataFrame([("0038060",), ("0031080",)], "area string")
    ids = [r["series_id"] for r in relate.series_ids(areas, "area", ["152051", "000000"]).collect()]
    assert sorted(ids) == [
        "OEUM0031080" + "000000" + j + "03" for j in ("000000", "152051")
    ] + ["OEUM0038060" + "000000" + j + "03" for j in ("000000", "152051")]


def test_union_users_prefers_new_rows(spark, rows):
    old = spark.createDataFrame([(1, "old"), (2, "old")], "user_id long, name string")
    new = spark.createDataFrame([("new", 2), ("new", 3), ("new", 3)], "name string, user_id long")
    assert rows(relate.union_users(old, new)) == [(1, "old"), (2, "new"), (3, "new")]
    assert relate.union_users(old, new, dedupe=False).count() == 5


def test_fact_lookup_reaches_area_through_series(spark, rows):
    series = spark.createDataFrame(
        [("s1", 10, "a1", "i9"), ("s2", 11, None, "i1")],
        "series_id string, dim_series_id long, area_code string, item_code string")
    area = spark.createDataFrame([("a1", 20)], "area_code string, dim_area_id long")
    item = spark.createDataFrame([("i1", 30)], "item_code string, dim_item_id long")
    facts = spark.createDataFrame([("s1", 1.0), ("s2", 2.0), ("s3", 3.0)], "series_id string, value double")
    assert rows(relate.fact_lookup(facts, series, area, item)) == [
        ("s1", 20, None, 10, 1.0), ("s2", None, 30, 11, 2.0), ("s3", None, None, None, 3.0)]


def test_dominant_series_is_split(spark):
    """A third of the readings belongs to one series, and no side is small enough to broadcast."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "128k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.shuffle.partitions": "8",
    }
    before = {name: spark.conf.get(name) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    key = F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 5000)
    readings = spark.range(0, 300_000, 1, 8).select(
        F.concat(F.lit("S"), key).alias("series_id"), (F.rand(1) * 100).alias("value"))
    series = spark.range(5000).selectExpr(
        "concat('S', id) AS series_id", "id AS dim_series_id", "'a' AS area_code", "'i' AS item_code")
    area = spark.createDataFrame([("a", 1)], "area_code string, dim_area_id long")
    item = spark.createDataFrame([("i", 2)], "item_code string, dim_item_id long")
    found = relate.fact_lookup(readings, series, area, item)
    found.write.format("noop").mode("overwrite").save()
    assert found.collect()[0]["dim_area_id"] == 1
    plan = found._jdf.queryExecution().executedPlan().toString()
    for name, value in before.items():
        spark.conf.set(name, value)
    assert "SortMergeJoin(skew=true)" in plan


def test_profile(spark):
    frame = spark.createDataFrame(
        [(1, 1.5, "x", True), (None, float("nan"), "y", True), (3, -0.0, "x", True), (3, 0.0, None, True)],
        "n long, v double, t string, flag boolean")
    found = {r["column_name"]: r for r in profile.profile_columns(frame).collect()}
    assert (found["n"]["null_count"], found["n"]["distinct_count"], found["n"]["max_number"]) == (1, 2, 3.0)
    assert (found["v"]["nan_count"], found["v"]["min_number"], found["v"]["max_number"]) == (1, 0.0, 1.5)
    assert found["v"]["distinct_count"] == 3
    assert (found["t"]["min_text"], found["t"]["max_text"], found["t"]["null_count"]) == ("x", "y", 1)
    assert found["flag"]["distinct_count"] == 1
    approx = {r["column_name"]: r["distinct_count"] for r in profile.profile_columns(frame, "approx").collect()}
    assert approx["t"] == 2


def test_profile_of_nothing(spark):
    found = profile.profile_columns(spark.createDataFrame([], "n long, t string")).collect()
    assert [(r["row_count"], r["distinct_count"], r["min_number"]) for r in found] == [(0, 0, None)] * 2


def test_key_check(spark):
    frame = spark.createDataFrame([(1, 1), (1, 2), (1, 2), (None, 3)], "a long, b long")
    assert tuple(profile.key_check(frame, ["a", "b"]).first()) == (4, 3, 1, 1, False)
    assert tuple(profile.key_check(frame.limit(0), ["a"]).first()) == (0, 0, 0, 0, True)


def test_table_sizes(spark, path):
    for name in ("one", "two"):
        writers.overwrite(spark.range(10), f"{path}/{name}")
    found = {r["table_name"]: r["size_bytes"] for r in profile.table_sizes(spark, path).collect()}
    assert set(found) == {"one", "two"} and min(found.values()) > 0
    assert [n for _, n in files.table_folders(spark, path)] == ["one", "two"]


def test_month_is_pruned(spark, path):
    frame = spark.createDataFrame([(1, "2022-06-01"), (2, "2022-07-01")], "id long, CreationMonth string")
    writers.overwrite(frame, path, ["CreationMonth"])
    month = files.read_month(spark, path, "2022-06-01")
    assert [r["id"] for r in month.collect()] == [1]
    assert "PartitionFilters: [isnotnull(CreationMonth" in month._jdf.queryExecution().executedPlan().toString()


def test_partitioned_write_makes_one_file_per_small_folder(spark, path):
    frame = spark.range(0, 1000, 1, 8).withColumn("m", F.col("id") % 3)
    writers.overwrite(frame, path, ["m"])
    assert len(spark.read.parquet(path).inputFiles()) == 3


def test_xml_with_sampled_schema(spark, path, rows):
    badges = spark.createDataFrame([(1, "x"), (2, "y")], "_Id long, _Name string")
    badges.write.format("xml").option("rootTag", "badges").option("rowTag", "row").save(f"{path}/xml")
    ingest.ingest_xml(spark, f"{path}/xml", "badges", f"{path}/out", sampling_ratio=1.0)
    assert rows(spark.read.parquet(f"{path}/out")) == [(1, "x"), (2, "y")]


def write_lines(spark, path, lines):
    spark.createDataFrame([(line,) for line in lines], "value string").coalesce(1).write.text(path)


def test_xml_finds_attributes_of_few_rows(spark, path):
    lines = ["<posts>", *[f'<row Id="{i}"/>' for i in range(5_000)], '<row Id="7" FavoriteCount="3"/>', "</posts>"]
    write_lines(spark, path, lines)
    found = files.read_xml(spark, path, "posts")
    assert found.columns == ["_FavoriteCount", "_Id"] and found.where("_FavoriteCount = 3").count() == 1
    with pytest.raises(Exception, match="attributes outside the sample"):
        files.read_xml(spark, path, "posts", sampling_ratio=0.0005).collect()


def test_xml_empty_attributes_are_null_unless_text(spark, path, rows):
    write_lines(spark, path, ['<row Id="1" S="" T="x" N=""/>', '<row Id="2" S="5" T=""/>', '<row Id="3" D=""/>'])
    found = files.read_xml(spark, path, "posts")
    assert dict(found.dtypes) == {"_D": "string", "_Id": "bigint", "_N": "string", "_S": "bigint", "_T": "string"}
    assert rows(found, "_Id", "_S", "_T") == [(1, None, "x"), (2, 5, ""), (3, None, None)]


def test_xml_quotes_of_both_kinds(spark, path, rows):
    lines = ["""<row Id='1' Body="it's A='no' >"/>""", """<row Id="2" Body='say "B=\\"9\\"" &lt;p&gt;' Rare='x'/>""".replace("\\", "")]
    write_lines(spark, path, lines)
    found = files.read_xml(spark, path, "posts")
    assert found.columns == ["_Body", "_Id", "_Rare"]
    assert rows(found, "_Id", "_Body", "_Rare") == [(1, "it's A='no' >", None), (2, 'say "B="9"" <p>', "x")]


def test_xml_single_quoted_attribute_outside_the_sample(spark, path):
    write_lines(spark, path, [*[f'<row Id="{i}"/>' for i in range(3_000)], "<row Id='7' Rare='x'/>"])
    with pytest.raises(Exception, match="attributes outside the sample: Rare"):
        files.read_xml(spark, path, "posts", sampling_ratio=0.001).collect()


def test_xml_lines_are_checked_before_types(spark, path):
    write_lines(spark, path, ["<posts>", '<row Id="1"', ' Score="2"/>', "</posts>"])
    with pytest.raises(Exception, match="not one XML row per line"):
        files.read_xml(spark, path, "posts").collect()
    write_lines(spark, f"{path}-none", ["<posts>", "</posts>"])
    none = files.read_xml(spark, f"{path}-none", "posts")
    assert none.columns == [] and none.count() == 0


@pytest.mark.parametrize(
    "values, kind",
    [
        (["1", "-20", ""], "bigint"),
        (["1", "2.5", "1e3"], "double"),
        (["12345678901234567890", "1"], "double"),
        (["true", "FALSE"], "boolean"),
        (["true", "1"], "string"),
        (["2020-01-02", "2020-02-30"], "string"),
        (["2020-01-02", "2020-01-03T04:05:06.789"], "timestamp_ntz"),
        (["2020-01-03T04:05:06Z", "2020-01-03T04:05:06+01:00"], "timestamp"),
        (["2020-01-03", "2020-01-03T04:05:06Z"], "string"),
        (["1", "x"], "string"),
        (["", ""], "string"),
        (["-"], "string"),
    ],
)
def test_xml_types_are_widened(spark, path, values, kind):
    write_lines(spark, path, [f'<row V="{v}"/>' for v in values])
    found = files.read_xml(spark, path, "posts")
    assert found.dtypes == [("_V", kind)] and found.count() == len(values)
    assert found.where("_V IS NOT NULL").count() == (len(values) if kind == "string" else len([v for v in values if v]))


def test_xml_rows_with_elements_inside(spark, path, rows):
    write_lines(spark, path, ['<row Id="1"><Name>a</Name></row>', '<row Id=""><Name>b</Name></row>'])
    assert rows(files.read_xml(spark, path, "posts"), "_Id", "Name") == [(1, "a"), (None, "b")]


def test_xml_values_that_do_not_fit(spark, path, rows):
    write_lines(spark, path, ['<row Id="1" Score="5"/>', '<row Id="2" Score="abc"/>'])
    with pytest.raises(Exception):
        files.read_xml(spark, path, "posts", schema="_Id long, _Score long").collect()
    kept = files.read_xml(spark, path, "posts", schema="_Id long, _Score long", corrupt_column="broken")
    assert kept.where("broken IS NOT NULL").count() == 1 and kept.where("_Id = 1 AND broken IS NULL").count() == 1


def test_pages_that_are_cut_off_fail(spark, path, rows):
    write_lines(spark, f"{path}/good", ['{"items": [{"id": 1}, {"id": 2}], "has_more": true, "page": 4}'])
    write_lines(spark, f"{path}/bad", ['{"items": [{"id": 1}, {"i'])
    assert rows(files.page_items(files.read_pages(spark, f"{path}/good", "id long"))) == [(1,), (2,)]
    everything = files.page_metadata(files.read_pages(spark, f"{path}/good", "id long", fields=None))
    assert rows(everything, "has_more", "page") == [(True, 4)]
    with pytest.raises(Exception):
        files.read_pages(spark, f"{path}/bad", "id long").collect()


def test_users_without_id_stay(spark):
    users = spark.createDataFrame([(1, "a"), (1, "b"), (None, "c"), (None, "d")], "user_id long, name string")
    assert relate.union_users(users, users.limit(0)).count() == 3


def test_profile_is_exact_and_complete(spark):
    big = 2**53 + 1
    frame = spark.createDataFrame([(big, [1, 2], "x" * 100), (1, [1, 2], "x" * 99 + "y")], "n long, a array<int>, t string")
    found = {r["column_name"]: r for r in profile.profile_columns(frame).collect()}
    assert (found["n"]["min_text"], found["n"]["max_text"]) == ("1", str(big))
    assert (found["a"]["distinct_count"], found["a"]["row_count"], found["a"]["max_text"]) == (1, 2, None)
    assert found["t"]["distinct_count"] == 2


def test_append_twice_keeps_both_and_merges_columns(spark, path, rows):
    writers.append_evolving(spark.createDataFrame([(1,)], "a long"), path)
    writers.append_evolving(spark.createDataFrame([(1, "n")], "a long, b string"), path)
    assert rows(files.read_evolved(spark, path)) == [(1, "n"), (1, None)] or rows(
        files.read_evolved(spark, path)) == [(1, None), (1, "n")]


def test_messages_go_to_any_sink(spark, path):
    frame = spark.createDataFrame([(1, "a")], "id long, v string")
    writers.send_messages(fn.key_value_messages(frame, "id"), {"path": path}, "parquet")
    assert spark.read.parquet(path).columns == ["key", "value"]


def test_failures_are_gathered_and_the_rest_is_loaded(spark):
    loaded = []

    def load(name):
        if name.startswith("bad"):
            raise ValueError(f"{name} is broken")
        loaded.append(name)
        return len(name)

    with pytest.raises(LoadError, match="bad1 is broken") as failure:
        run_tables(spark, ["a", "bad1", "b", "bad2"], load, workers=2)
    assert sorted(loaded) == ["a", "b"] and set(failure.value.errors) == {"bad1", "bad2"}
    status = {r["table_name"]: r["succeeded"] for r in failure.value.status.collect()}
    assert status == {"a": True, "b": True, "bad1": False, "bad2": False}


def test_database_ingest_into_catalog(spark, path, rows):
    """The reader is replaced: no database is to be had in a test."""
    catalog.create_database(spark, "ingested", f"{path}/db", replace=True)
    frames = {"Badges": spark.range(3), "Votes": spark.range(5)}
    ingest.ingest_database(spark, {}, "ingested", list(frames), read=frames.__getitem__)
    assert spark.table("ingested.badges").count() == 3 and spark.table("ingested.votes").count() == 5
    catalog.create_database(spark, "ingested", f"{path}/db2", replace=True)
    assert spark.sql("SHOW TABLES IN ingested").where("NOT isTemporary").count() == 0


def test_split_reads_need_bounds():
    assert jdbc.split_options("id", None, None, 4) == {}
    assert jdbc.split_options("id", 1, 90, 4) == {
        "partitionColumn": "id", "lowerBound": "1", "upperBound": "90", "numPartitions": "4"}


def test_listing_is_tried_twice(spark, monkeypatch):
    calls = []

    def fail_once(*_):
        calls.append(1)
        if len(calls) == 1:
            raise RuntimeError("asleep")
        return spark.createDataFrame([("Posts",)], "table_name string")

    monkeypatch.setattr(jdbc, "read_query", fail_once)
    assert jdbc.list_tables(spark, {}, wait_seconds=0) == ["Posts"]


def test_curated_tables_can_be_created(spark, path):
    catalog.create_database(spark, "curated_test", path, replace=True)
    for name, columns in catalog.CURATED_TABLES.items():
        catalog.create_table(spark, f"curated_test.{name}", columns)
        assert "CREATE TABLE" in catalog.create_statement(spark, f"curated_test.{name}")
    catalog.drop_table(spark, "curated_test.dim_area")
    assert spark.sql("SHOW TABLES IN curated_test").where("NOT isTemporary").count() == 3
