"""Curated loads: ids, watermarks, rejects, failures."""

from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from lakeops.plans import star
from lakeops.plans.jobs import LoadError
from lakeops.plans.refined import RefinedTable, load_refined
from lakeops.sources.writers import overwrite
from lakeops.tables.versioned import VersionedTable

T = [datetime(2022, 1, day) for day in range(1, 8)]


@pytest.fixture
def refined(spark, path):
    """Refined area, item and series tables with a reading table beside them."""

    def sync(name, rows, schema, keys, when):
        VersionedTable(spark, f"{path}/refined/{name}").sync(spark.createDataFrame(rows, schema), keys, when)

    def load(when, areas, items, series, readings):
        sync("area", areas, "area_code string, area_name string", ["area_code"], when)
        sync("item", items, "item_code string, item_name string", ["item_code"], when)
        sync("series", series, "series_id string, area_code string, item_code string", ["series_id"], when)
        sync("current", readings, "series_id string, year long, period string, value double",
             ["series_id", "year", "period"], when)
        return star.load_star(spark, f"{path}/refined", f"{path}/curated", when)

    return load


def fact(spark, path):
    return VersionedTable(spark, f"{path}/curated/fact_current")


FACTS = ["dim_series_id", "dim_area_id", "dim_item_id", "year", "period", "value", "is_deleted"]


def test_two_loads(spark, path, rows, refined):
    areas, items = [("A", "north"), ("B", "south")], [("I", "milk")]
    refined(T[0], areas, items, [("s1", "A", "I")], [("s1", 2020, "M01", 1.0), ("s2", 2020, "M01", 9.0)])
    assert rows(fact(spark, path).read(), *FACTS) == [(1, 1, 1, 2020, "M01", 1.0, False)]
    assert rows(star.rejects(fact(spark, path)), "series_id", "value") == [("s2", 9.0)]

    # s2 becomes known, with an unknown area; s1's reading goes; area A is renamed.
    status = refined(
        T[1], [("A", "NORTH"), ("B", "south"), ("0", "first")], items,
        [("s1", "A", "I"), ("s2", "Z", "I")], [("s2", 2020, "M01", 9.0), ("s2", 2020, "M02", 8.0)])
    assert rows(fact(spark, path).read(), *FACTS) == [
        (1, 1, 1, 2020, "M01", 1.0, True), (2, None, 1, 2020, "M01", 9.0, False),
        (2, None, 1, 2020, "M02", 8.0, False)]
    assert star.rejects(fact(spark, path)).count() == 0
    area = VersionedTable(spark, f"{path}/curated/dim_area").read()
    assert rows(area, "dim_area_id", "area_code", "area_name", "is_deleted", "last_modified") == [
        (1, "A", "NORTH", False, T[1]), (2, "B", "south", False, T[0]), (3, "0", "first", False, T[1])]
    assert {r["table_name"]: r["result"] for r in status.collect()} == {
        "dim_area": "1", "dim_series": "1", "dim_item": None, "fact_current": "1"}


def test_no_new_changes_is_success(spark, path, refined):
    data = ([("A", "n")], [("I", "m")], [("s", "A", "I")], [("s", 2020, "M01", 1.0)])
    refined(T[0], *data)
    status = refined(T[1], *data)
    assert [r["result"] for r in status.collect()] == [None] * 4
    assert fact(spark, path).state().version == 0


def test_several_commits_between_loads(spark, path, rows):
    source, dim = (VersionedTable(spark, f"{path}/{n}") for n in ("item", "dim_item"))

    def sync(value, when):
        source.sync(spark.createDataFrame(value, "item_code string, item_name string"), ["item_code"], when)

    sync([("a", "1")], T[0])
    star.load_dimension(source, dim, "item_code", "dim_item_id", T[0])
    sync([("a", "2"), ("b", "1")], T[1])
    sync([("a", "3"), ("b", "1")], T[1])  # within the same second
    sync([("a", "3")], T[2])
    assert star.load_dimension(source, dim, "item_code", "dim_item_id", T[2]) == 1
    assert rows(dim.read(), "dim_item_id", "item_code", "item_name", "is_deleted") == [
        (1, "a", "3", False), (2, "b", "1", True)]


def test_removed_rows_of_an_overwrite_become_marked(spark, path, rows):
    source, dim = (VersionedTable(spark, f"{path}/{n}") for n in ("item", "dim_item"))
    schema = "item_code string, item_name string, is_deleted boolean"
    source.overwrite(spark.createDataFrame([("a", "1", False), ("b", "1", False)], schema), (), T[0])
    star.load_dimension(source, dim, "item_code", "dim_item_id", T[0])
    source.overwrite(spark.createDataFrame([("a", "2", False)], schema), (), T[1])
    star.load_dimension(source, dim, "item_code", "dim_item_id", T[1])
    assert rows(dim.read(), "dim_item_id", "item_code", "item_name", "is_deleted") == [
        (1, "a", "2", False), (2, "b", "1", True)]


def test_failed_dimension_stops_the_fact(spark, path, refined):
    refined(T[0], [("A", "n")], [("I", "m")], [("s", "A", "I")], [("s", 2020, "M01", 1.0)])
    lacking = (star.Dimension("absent", "dim_absent", "k", "dim_id"), *star.PRICE_DIMENSIONS)
    with pytest.raises(LoadError) as failure:
        star.load_star(spark, f"{path}/refined", f"{path}/other", T[1], dimensions=lacking)
    assert list(failure.value.errors) == ["dim_absent"]
    assert failure.value.status.where("succeeded").count() == 3
    assert not VersionedTable(spark, f"{path}/other/fact_current").exists()


def test_refined_load_takes_expressions_and_adds_keys(spark, path, rows):
    badges = spark.createDataFrame([(1, "b", 7)], "_Id long, _Name string, _UserId long")
    overwrite(badges, f"{path}/raw/badges")
    config = RefinedTable("badges", ["id"], ["_ID as id", "_Name as name", "_UserId as userid"])
    assert load_refined(spark, config, f"{path}/raw", f"{path}/refined") == 0
    assert rows(VersionedTable(spark, f"{path}/refined/badges").read()) == [(1, "b", 7, False)]
    assert RefinedTable("t", ["a", "b"], ["a", "c"]).selected() == ["b", "a", "c"]


def test_wrong_column_is_an_error(spark, path):
    overwrite(spark.range(3).withColumn("v", F.lit(1)), f"{path}/raw/t")
    with pytest.raises(Exception, match="nowhere"):
        load_refined(spark, RefinedTable("t", ["id"], ["id", "nowhere"]), f"{path}/raw", f"{path}/refined")


def test_a_load_of_rejects_only_shows_them(spark, path, rows, refined):
    areas, items, series = [("A", "north")], [("I", "milk")], [("s1", "A", "I")]
    refined(T[0], areas, items, series, [("s1", 2020, "M01", 1.0)])
    before = fact(spark, path).read().count()
    refined(T[1], areas, items, series, [("s1", 2020, "M01", 1.0), ("s9", 2020, "M01", 5.0)])
    assert fact(spark, path).read().count() == before
    assert rows(star.rejects(fact(spark, path)), "series_id", "value") == [("s9", 5.0)]


def test_a_dimension_that_was_overwritten_goes_on(spark, path, rows, refined):
    areas, items = [("A", "north")], [("I", "milk")]
    refined(T[0], areas, items, [("s1", "A", "I")], [("s1", 2020, "M01", 1.0)])
    dimension = VersionedTable(spark, f"{path}/curated/dim_area")
    dimension.overwrite(dimension.read(), None, T[1])
    refined(T[1], [("A", "north"), ("B", "new")], items, [("s1", "A", "I")], [("s1", 2020, "M01", 1.0)])
    assert rows(dimension.read(), "dim_area_id", "area_code") == [(1, "A"), (2, "B")]


def test_partitioned_dimension_rewrites_what_changes_and_leaves_no_scratch(spark, path, rows):
    import os

    source, target = VersionedTable(spark, f"{path}/item"), VersionedTable(spark, f"{path}/dim_item")
    frame = lambda *r: spark.createDataFrame(list(r), "code string, kind string, name string")
    source.sync(frame(("a", "x", "one"), ("b", "y", "two"), ("c", "y", "three")), ["code"])
    root = os.path.dirname(path).removeprefix("file:")
    before = set(os.listdir(root))
    assert star.load_dimension(source, target, "code", "id", partition_by=["kind"]) == 0
    source.sync(frame(("a", "x", "one"), ("b", "y", "TWO"), ("d", "x", "four")), ["code"])
    assert star.load_dimension(source, target, "code", "id") == 1
    assert rows(target.read(), "id", "code", "kind", "name", "is_deleted") == [
        (1, "a", "x", "one", False), (2, "b", "y", "TWO", False), (3, "c", "y", "three", True), (4, "d", "x", "four", False)]
    source.sync(frame(("a", "x", "one"), ("b", "y", "2"), ("d", "x", "four")), ["code"])
    star.load_dimension(source, target, "code", "id")
    assert target.state().folders == {"kind=x": 1, "kind=y": 2}
    assert set(os.listdir(root)) == before


def test_only_the_newest_image_of_a_reading_waits(spark, path, rows, refined):
    areas, items, series = [("A", "north")], [("I", "milk")], [("s1", "A", "I")]
    refined(T[0], areas, items, series, [("s9", 2020, "M01", 5.0), ("s9", 2020, "M02", 2.0)])
    refined(T[1], areas, items, series, [("s9", 2020, "M01", 6.0), ("s9", 2020, "M02", 2.0)])
    assert rows(star.rejects(fact(spark, path)), "series_id", "period", "value") == [
        ("s9", "M01", 6.0), ("s9", "M02", 2.0)]
    refined(T[2], areas, items, [*series, ("s9", "A", "I")], [("s9", 2020, "M01", 6.0), ("s9", 2020, "M02", 3.0)])
    assert rows(fact(spark, path).read(), "period", "value") == [("M01", 6.0), ("M02", 3.0)]
    assert star.rejects(fact(spark, path)).count() == 0


def test_images_of_one_load_are_read_without_a_search(spark, path, rows):
    source = VersionedTable(spark, f"{path}/item")
    source.sync(spark.createDataFrame([("a", "1")], "code string, name string"), ["code"], T[0])
    images, newest, plain = star.new_images(source, None, ["code"])
    assert plain and newest == 0 and "Window" not in images._jdf.queryExecution().executedPlan().toString()
    assert rows(images, "code", "name") == [("a", "1")]
