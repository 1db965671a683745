"""Refined and curated loads.

Suppliers are the areas, parts the items, each pair of part and supplier a series, and the
quantity shipped per series and month a reading. Two extracts arrive one after the other. The
first ends with 1999, and lacks the series which until then had no finished line. The second holds
everything but the readings of 1995, and those of 1999 are one higher.
"""

from __future__ import annotations

import uuid
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from lakeops.catalogue import query, table
from lakeops.operators.merge import DELETED
from lakeops.plans import star
from lakeops.plans.jobs import run_tables
from lakeops.plans.refined import RefinedTable, load_all_refined
from lakeops.session import scratch_path, written
from lakeops.sources.writers import few_folders, overwrite
from lakeops.tables import catalog
from lakeops.tables.versioned import VersionedTable

REFINED = (
    RefinedTable("area", ["area_code"], ["area_code", "area_name", "display_level"]),
    RefinedTable("item", ["item_code"], ["item_code", "item_name", "display_level", "sort_sequence"]),
    RefinedTable("series", ["series_id"], ["series_id", "area_code", "item_code"]),
    # The period belongs to the key, so it is loaded although the list lacks it.
    RefinedTable("current", ["series_id", "year", "period"], ["series_id", "year", "value"], ["year"]),
)
FIRST, SECOND = datetime(2022, 5, 1, 6, 0, 0), datetime(2022, 6, 1, 6, 0, 0)
LAST_FIRST_YEAR = 1999

LINES_SQL = """
lines AS (
  SELECT concat('S', l_partkey, '-', l_suppkey) AS series_id, concat('A', l_suppkey) AS area_code,
         concat('I', l_partkey) AS item_code, year(l_shipdate)::BIGINT AS year,
         strftime(l_shipdate, 'M%m') AS period, l_quantity, l_returnflag
  FROM lineitem),
readings AS (
  SELECT series_id, year, period, sum(l_quantity) + max(CASE WHEN year = 1999 THEN 1 ELSE 0 END) AS value,
         sum(l_quantity) AS first_value
  FROM lines GROUP BY series_id, year, period),
series AS (
  SELECT series_id, any_value(area_code) AS area_code, any_value(item_code) AS item_code,
         bool_or(l_returnflag != 'N' AND year <= 1999) AS early
  FROM lines GROUP BY series_id)"""
DIMENSIONS_SQL = """
dim_area AS (
  SELECT row_number() OVER (ORDER BY concat('A', s_suppkey))::BIGINT AS dim_area_id,
         concat('A', s_suppkey) AS area_code FROM supplier),
dim_item AS (
  SELECT row_number() OVER (ORDER BY concat('I', p_partkey))::BIGINT AS dim_item_id,
         concat('I', p_partkey) AS item_code FROM part),
dim_series AS (
  SELECT row_number() OVER (ORDER BY CASE WHEN early THEN 0 ELSE 1 END, series_id)::BIGINT
         AS dim_series_id, series_id, area_code, item_code FROM series)"""
FACTS_SQL = f"""
WITH {LINES_SQL}, {DIMENSIONS_SQL},
facts AS (
  SELECT dim_series_id, dim_area_id, dim_item_id, r.year, r.period,
         CASE WHEN r.year = 1995 THEN r.first_value ELSE r.value END AS value,
         r.year = 1995 AS is_deleted
  FROM readings r JOIN dim_series USING (series_id) JOIN dim_area USING (area_code)
       JOIN dim_item USING (item_code))"""


def shipped(spark: SparkSession, folder: str) -> DataFrame:
    """Quantity per series and month, whether the series is in the first extract, and one row of each marked.

    Lines are dealt by series once, for the sums and for what is told of a series; the month, counted from
    year 0, is one number. Names are made by those who read the rows.
    """
    lines = table(spark, folder, "lineitem").selectExpr(
        "l_partkey",
        "l_suppkey",
        "year(l_shipdate) * 12 + month(l_shipdate) - 1 AS month",
        "l_quantity",
        f"l_returnflag != 'N' AND year(l_shipdate) <= {LAST_FIRST_YEAR} AS early",
    )
    monthly = lines.repartition("l_partkey", "l_suppkey").groupBy("l_partkey", "l_suppkey", "month").agg(
        F.sum("l_quantity").alias("value"), F.bool_or("early").alias("early")
    )
    series = Window.partitionBy("l_partkey", "l_suppkey").orderBy("month")
    whole = series.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return monthly.withColumn("early", F.bool_or("early").over(whole)).withColumn(
        "first", F.row_number().over(series) == 1
    )


def named(shipments: DataFrame) -> DataFrame:
    """Shipments with the names of series, area, item and period."""
    return shipments.selectExpr(
        "concat('S', l_partkey, '-', l_suppkey) AS series_id",
        "concat('A', l_suppkey) AS area_code",
        "concat('I', l_partkey) AS item_code",
        "CAST(month DIV 12 AS BIGINT) AS year",
        "concat('M', lpad(CAST(month % 12 + 1 AS STRING), 2, '0')) AS period",
        "value",
        "early",
        "first",
    )


def write_raw(
    spark: SparkSession, folder: str, shipments: DataFrame, root: str, second: bool
) -> None:
    """One extract of the four raw tables."""
    areas = table(spark, folder, "supplier").selectExpr(
        "concat('A', s_suppkey) AS area_code", "s_name AS area_name",
        "CAST(s_nationkey AS BIGINT) AS display_level", "s_suppkey AS sort_sequence",
    )
    items = table(spark, folder, "part").selectExpr(
        "concat('I', p_partkey) AS item_code", "p_name AS item_name",
        "CAST(p_size AS BIGINT) AS display_level", "p_partkey AS sort_sequence",
        "'T' AS selectable",
    )
    shipments = named(shipments)
    series = shipments.where("first")
    if second:
        raised = F.when(F.col("year") == LAST_FIRST_YEAR, 1).otherwise(0)
        values = shipments.where("year != 1995").withColumn("value", F.col("value") + raised)
    else:
        values = shipments.where(F.col("year") <= LAST_FIRST_YEAR)
        series = series.where("early")
    values = values.select("series_id", "year", "period", "value", F.lit(float("nan")).alias("footnote_codes"))
    series = series.select("series_id", "area_code", "item_code")
    raw = {"area": areas, "item": items, "series": series, "current": values}
    run_tables(spark, raw, lambda name: overwrite(raw[name], f"{root}/{name}"))


def loaded_star(spark: SparkSession, folder: str, rounds: int = 2) -> tuple[str, DataFrame]:
    """Both extracts, from raw to curated. The folder of the curated tables, and the last status."""
    root = scratch_path(spark, "star")
    status = None
    shipments = written(shipped(spark, folder), "shipments")
    for number, when in enumerate((FIRST, SECOND)[:rounds]):
        raw = f"{root}/raw-{number}"
        write_raw(spark, folder, shipments, raw, second=number == 1)
        load_all_refined(spark, REFINED, raw, f"{root}/refined", committed_at=when)
        status = star.load_star(
            spark, f"{root}/refined", f"{root}/curated", when, partition_by=["year"]
        )
    return f"{root}/curated", status


@query(f"{FACTS_SQL} SELECT * FROM facts")
def star_load(spark: SparkSession, folder: str) -> DataFrame:
    """Raw to refined to curated, twice; the resulting facts."""
    curated, _ = loaded_star(spark, folder)
    return VersionedTable(spark, f"{curated}/fact_current").read().drop(star.MODIFIED)


@query(
    f"""WITH {LINES_SQL}
    SELECT series_id, year, period, first_value AS value FROM readings JOIN series USING (series_id)
    WHERE year <= 1999 AND NOT early"""
)
def star_rejects(spark: SparkSession, folder: str) -> DataFrame:
    """Readings whose series is still unknown after the first extract."""
    curated, _ = loaded_star(spark, folder, rounds=1)
    waiting = star.rejects(VersionedTable(spark, f"{curated}/fact_current"))
    return waiting.select("series_id", "year", "period", "value")


def item_dimension(spark: SparkSession, folder: str) -> VersionedTable:
    """The item dimension after two loads of a refined table of parts.

    The first extract lacks the small parts; the second lacks one brand of the first one and renames
    another. Each part is in one of them.
    """
    root = scratch_path(spark, "item")
    refined, dimension = VersionedTable(spark, f"{root}/item"), VersionedTable(spark, f"{root}/dim_item")
    items = table(spark, folder, "part").selectExpr(
        "concat('I', p_partkey) AS item_code", "p_name AS item_name", "p_brand", "p_type"
    )
    first = items.where("p_type != 'SMALL'").select("item_code", "item_name")
    second = items.where("p_brand != 'Brand#2' OR p_type = 'SMALL'").selectExpr(
        "item_code", "CASE WHEN p_brand = 'Brand#4' THEN upper(item_name) ELSE item_name END AS item_name"
    )
    for extract, when in ((first, FIRST), (second, SECOND)):
        refined.sync(extract, ["item_code"], when)
        star.load_dimension(refined, dimension, "item_code", "dim_item_id", when)
    return dimension


@query(
    """WITH known AS (
      SELECT row_number() OVER (
               ORDER BY CASE WHEN p_type != 'SMALL' THEN 0 ELSE 1 END, concat('I', p_partkey))::BIGINT
               AS dim_item_id,
             concat('I', p_partkey) AS item_code,
             CASE WHEN p_brand = 'Brand#4' THEN upper(p_name) ELSE p_name END AS item_name,
             p_brand = 'Brand#2' AND p_type != 'SMALL' AS is_deleted
      FROM part)
    SELECT * FROM known"""
)
def dim_load(spark: SparkSession, folder: str) -> DataFrame:
    return item_dimension(spark, folder).read().drop(star.MODIFIED)


@query(
    """SELECT concat('I', p_partkey) AS item_code,
       row_number() OVER (ORDER BY CASE WHEN p_type != 'SMALL' THEN 0 ELSE 1 END, concat('I', p_partkey))::BIGINT
         AS dim_item_id,
       CASE WHEN p_brand = 'Brand#2' AND p_type != 'SMALL' THEN p_name ELSE upper(p_name) END AS item_name,
       p_brand = 'Brand#2' AND p_type != 'SMALL' AS is_deleted
    FROM part"""
)
def dim_after_overwrite(spark: SparkSession, folder: str) -> DataFrame:
    """A dimension loaded behind an overwrite of its source: ids stay, what is gone is marked."""
    root = scratch_path(spark, "item")
    source, dimension = VersionedTable(spark, f"{root}/item"), VersionedTable(spark, f"{root}/dim_item")
    items = table(spark, folder, "part").withColumn(DELETED, F.lit(False))
    columns = ["concat('I', p_partkey) AS item_code", "p_name AS item_name", DELETED]
    later = ["concat('I', p_partkey) AS item_code", "upper(p_name) AS item_name", DELETED]
    source.overwrite(items.where("p_type != 'SMALL'").selectExpr(*columns), committed_at=FIRST)
    star.load_dimension(source, dimension, "item_code", "dim_item_id", FIRST)
    source.overwrite(items.where("p_brand != 'Brand#2' OR p_type = 'SMALL'").selectExpr(*later), committed_at=SECOND)
    star.load_dimension(source, dimension, "item_code", "dim_item_id", SECOND)
    return dimension.read().drop(star.MODIFIED)


# The posts area: raw names with an underscore, refined under their own names.
POSTS_AREA = (
    RefinedTable("badges", ["id"], ["_Class AS class", "_Id AS id", "_Name AS name", "_UserId AS userid"]),
    RefinedTable(
        "comments", ["id"], ["_Id AS id", "_PostId AS post_id", "_Score AS score", "_Text AS text", "_UserId AS user_id"]
    ),
)


@query(
    """SELECT 'badges' AS table_name, e.event_id AS id, e.event_type AS label, e.user_id AS user_id,
       e.event_type = 'signup' AS is_deleted FROM events e
    UNION ALL
    SELECT 'comments', o_orderkey, CASE WHEN o_orderstatus = 'O' THEN upper(o_orderpriority) || '!'
                                        ELSE o_orderpriority END, o_custkey, o_orderstatus = 'P' FROM orders"""
)
def posts_refined(spark: SparkSession, folder: str) -> DataFrame:
    """The refined load of the posts area, from two extracts; renamed columns, one row per line of either."""
    root = scratch_path(spark, "posts-area")
    events, orders = table(spark, folder, "events"), table(spark, folder, "orders")
    for second, when in ((False, FIRST), (True, SECOND)):
        badges = events.selectExpr(
            "event_id AS _Id", "event_type AS _Name", "user_id AS _UserId", "1 AS _Class", "ts AS _Date"
        )
        text = "CASE WHEN o_orderstatus = 'O' THEN upper(o_orderpriority) || '!' ELSE o_orderpriority END"
        comments = orders.selectExpr(
            "o_orderkey AS _Id", "o_custkey AS _UserId", "o_custkey AS _PostId", "o_totalprice AS _Score",
            f"{text if second else 'o_orderpriority'} AS _Text", "o_orderstatus",
        )
        if second:
            badges, comments = badges.where("_Name != 'signup'"), comments.where("o_orderstatus != 'P'")
        raw = f"{root}/raw-{int(second)}"
        overwrite(badges, f"{raw}/badges")
        overwrite(comments, f"{raw}/comments")
        load_all_refined(spark, POSTS_AREA, raw, f"{root}/refined", committed_at=when, workers=3, seconds=1_800)
    badges, comments = (VersionedTable(spark, f"{root}/refined/{c.name}").read() for c in POSTS_AREA)
    return badges.select(
        F.lit("badges").alias("table_name"), "id", F.col("name").alias("label"), F.col("userid").alias("user_id"), DELETED
    ).unionByName(
        comments.select(F.lit("comments").alias("table_name"), "id", F.col("text").alias("label"), "user_id", DELETED)
    )


def readings(spark: SparkSession, folder: str, second: bool) -> DataFrame:
    """Orders as monthly readings of customers; the second extract raises the prices of 1999."""
    price = "sum(CAST(round(o_totalprice) AS BIGINT))"
    if second:
        price += " + max(CASE WHEN year(o_orderdate) = 1999 THEN 1 ELSE 0 END)"
    orders = table(spark, folder, "orders")
    if not second:
        orders = orders.where("o_orderdate < TIMESTAMP_NTZ'2000-01-01 00:00:00'")
    month = "concat('M', lpad(CAST(month(o_orderdate) AS STRING), 2, '0'))"
    return orders.groupBy(
        F.expr("concat('S', o_custkey)").alias("series_id"),
        F.expr("CAST(year(o_orderdate) AS BIGINT)").alias("year"),
        F.expr(month).alias("period"),
    ).agg(F.expr(f"CAST({price} AS DOUBLE)").alias("value"))


@query(
    """WITH facts AS (
      SELECT o_custkey, year(o_orderdate)::BIGINT AS year, strftime(o_orderdate, 'M%m') AS period,
             (sum(round(o_totalprice)::BIGINT)
               + max(CASE WHEN year(o_orderdate) = 1999 THEN 1 ELSE 0 END))::DOUBLE AS value
      FROM orders GROUP BY ALL)
    SELECT c_name AS area_name, year, count(*) AS reading_count, sum(value)::BIGINT AS total_value
    FROM facts JOIN customer ON o_custkey = c_custkey GROUP BY ALL"""
)
def fact_load(spark: SparkSession, folder: str) -> DataFrame:
    """Two loads of a fact table against given dimensions, reported by area through SQL views."""
    root = scratch_path(spark, "facts")
    source, fact = VersionedTable(spark, f"{root}/current"), VersionedTable(spark, f"{root}/fact")
    customers = table(spark, folder, "customer")
    dimensions = {
        "series": customers.selectExpr(
            "c_custkey + 1 AS dim_series_id", "concat('S', c_custkey) AS series_id",
            "c_name AS area_code", "c_mktsegment AS item_code",
        ),
        "area": customers.selectExpr("c_custkey AS dim_area_id", "c_name AS area_code"),
        "item": customers.selectExpr(
            "length(c_mktsegment) AS dim_item_id", "c_mktsegment AS item_code"
        ).distinct(),
    }
    years = table(spark, folder, "orders").selectExpr("year(o_orderdate) AS year")
    few = few_folders(years, ["year"])
    for second, when in ((False, FIRST), (True, SECOND)):
        extract = readings(spark, folder, second)
        source.sync(extract, star.READING_KEY, when, ["year"], grouped=True, gathered=few)
        star.load_fact(source, dimensions, fact, when, ["year"])
    view = f"fact_{uuid.uuid4().hex}"
    catalog.view(fact, view)
    dimensions["area"].createOrReplaceTempView(f"{view}_area")
    return spark.sql(
        f"""SELECT a.area_code AS area_name, f.year, count(*) AS reading_count,
                   CAST(sum(f.value) AS BIGINT) AS total_value
        FROM {view} f JOIN {view}_area a ON f.dim_area_id = a.dim_area_id
        WHERE NOT f.is_deleted GROUP BY a.area_code, f.year"""
    )


@query(
    """SELECT 'area' AS table_name, count(*) AS row_count FROM supplier
    UNION ALL SELECT 'item', count(*) FROM part
    UNION ALL SELECT 'series', count(DISTINCT (l_partkey, l_suppkey)) FROM lineitem
    UNION ALL SELECT 'current', count(DISTINCT (l_partkey, l_suppkey, year(l_shipdate), month(l_shipdate)))
      FROM lineitem WHERE year(l_shipdate) != 1995"""
)
def refined_load(spark: SparkSession, folder: str) -> DataFrame:
    """Four refined tables loaded side by side from two extracts; the active rows of each."""
    root = scratch_path(spark, "refined")
    shipments = written(shipped(spark, folder), "shipments")
    for second, when in ((False, FIRST), (True, SECOND)):
        raw = f"{root}/raw-{int(second)}"
        write_raw(spark, folder, shipments, raw, second)
        load_all_refined(spark, REFINED, raw, f"{root}/refined", committed_at=when)
    result = None
    for config in REFINED:
        rows = VersionedTable(spark, f"{root}/refined/{config.name}").read().where(~F.col(DELETED))
        counted = rows.agg(
            F.lit(config.name).alias("table_name"), F.count(F.lit(1)).alias("row_count")
        )
        result = counted if result is None else result.unionByName(counted)
    return result
