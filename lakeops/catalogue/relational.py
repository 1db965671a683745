"""Projections, expressions, filters, joins, paging and profiles."""

from __future__ import annotations

import itertools

from pyspark.sql import DataFrame, SparkSession, functions as F

from lakeops.catalogue import query, table
from lakeops.functions import (
    epoch_between,
    epoch_to_timestamp,
    expand_json,
    key_value_messages,
    month_start,
    tag_array,
)
from lakeops.operators import numbering, profile, relate
from lakeops.plans.ingest import enrich_posts
from lakeops.session import scratch_path
from lakeops.sources import files

# --- projections -------------------------------------------------------------------------------


@query("SELECT o_orderkey, o_custkey, o_totalprice FROM orders")
def scan_select(spark: SparkSession, folder: str) -> DataFrame:
    return files.read_table(
        spark, f"{folder}/orders.parquet", ["o_orderkey", "o_custkey", "o_totalprice"]
    )


@query("SELECT c_custkey AS id, c_name AS display_name, c_acctbal AS balance FROM customer")
def rename_select(spark: SparkSession, folder: str) -> DataFrame:
    """Names are found whatever their case."""
    return files.read_table(
        spark,
        f"{folder}/customer.parquet",
        ["C_CustKey AS id", "C_Name AS display_name", "c_acctbal AS balance"],
    )


@query("SELECT * FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 30")
def sql_on_path(spark: SparkSession, folder: str) -> DataFrame:
    """The first thirty rows of a path, as a report."""
    return files.sql_on_path(
        spark, f"{folder}/orders.parquet", "ORDER BY o_totalprice DESC, o_orderkey LIMIT 30"
    )


@query("SELECT *, strftime(o_orderdate, '%Y-%m-01') AS order_month FROM orders")
def month_bucket(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "orders").select("*", month_start("o_orderdate").alias("order_month"))


@query(
    """SELECT page_id, array_to_string(regexp_extract_all(html, '(<[^<>]*>)', 0), ' ') AS tags,
       len(regexp_extract_all(html, '(<[^<>]*>)', 0))::BIGINT AS tag_count FROM pages"""
)
def tags_array(spark: SparkSession, folder: str) -> DataFrame:
    tagged = table(spark, folder, "pages").select("page_id", tag_array("html").alias("tags"))
    return tagged.select(
        "page_id",
        F.array_join("tags", " ").alias("tags"),
        F.size("tags").cast("long").alias("tag_count"),
    )


def events_as_posts(spark: SparkSession, folder: str) -> DataFrame:
    """Events under the names of the post dump."""
    return table(spark, folder, "events").select(
        F.col("event_id").alias("_Id"),
        F.col("user_id").alias("_OwnerUserId"),
        F.concat(F.lit("<"), "event_type", F.lit("><"), F.col("user_id"), F.lit(">")).alias("_Tags"),
        F.col("value").alias("_Score"),
        F.col("ts").alias("_CreationDate"),
        F.expr("CASE WHEN event_type = 'error' THEN NULL ELSE ts + INTERVAL 20 DAY END").alias(
            "_LastEditDate"
        ),
        F.expr("ts + INTERVAL 40 DAY").alias("_LastActivityDate"),
    )


@query(
    """SELECT event_id AS _Id, concat('<', event_type, '>|<', user_id, '>') AS TagsText,
       strftime(ts, '%Y-%m-01') AS CreationMonth,
       CASE WHEN event_type = 'error' THEN NULL
            ELSE strftime(ts + INTERVAL 20 DAY, '%Y-%m-01') END AS LastEditMonth,
       strftime(ts + INTERVAL 40 DAY, '%Y-%m-01') AS LastActivityMonth
    FROM events"""
)
def post_enrich(spark: SparkSession, folder: str) -> DataFrame:
    return enrich_posts(events_as_posts(spark, folder)).select(
        "_Id",
        F.array_join("TagsArray", "|").alias("TagsText"),
        "CreationMonth",
        "LastEditMonth",
        "LastActivityMonth",
    )


@query(
    """SELECT CASE WHEN event_type = 'error' THEN NULL
       ELSE CAST(json_extract(props, '$.k') AS BIGINT) END AS k FROM events"""
)
def json_parse(spark: SparkSession, folder: str) -> DataFrame:
    """Error events carry a text which is not JSON."""
    events = table(spark, folder, "events").select(
        F.expr("CASE WHEN event_type = 'error' THEN 'not ' || props ELSE props END").alias("value")
    )
    return expand_json(events, "value", "k long")


@query(
    """SELECT event_id::VARCHAR AS key, 6::BIGINT AS field_count, event_id::VARCHAR AS event_id, event_type, value,
       props FROM events"""
)
def message_envelope(spark: SparkSession, folder: str) -> DataFrame:
    """Rows as messages; the two engines spell JSON numbers differently, so the text is taken apart."""
    messages = key_value_messages(table(spark, folder, "events"), "event_id")
    field = lambda name: F.get_json_object("value", f"$.{name}")
    return messages.select(
        "key",
        F.size(F.json_object_keys("value")).cast("long").alias("field_count"),
        field("event_id").alias("event_id"),
        field("event_type").alias("event_type"),
        field("value").cast("double").alias("value"),
        field("props").alias("props"),
    )


@query("SELECT event_id::VARCHAR AS key, event_id, user_id, event_type, value, props FROM events")
def message_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    """Rows to messages and back."""
    fields = "event_id long, user_id long, event_type string, value double, props string"
    messages = key_value_messages(table(spark, folder, "events"), "event_id")
    return messages.select("key", F.from_json("value", fields).alias("row")).select("key", "row.*")


@query(
    """SELECT lpad(c_custkey::VARCHAR, 7, '0') AS area_code, job_code,
       concat('OEUM', lpad(c_custkey::VARCHAR, 7, '0'), '000000', job_code, '03') AS series_id
    FROM customer, (SELECT unnest(['152051', '151252', '000000']) AS job_code)"""
)
def series_ids(spark: SparkSession, folder: str) -> DataFrame:
    areas = table(spark, folder, "customer").select(
        F.lpad(F.col("c_custkey").cast("string"), 7, "0").alias("code")
    )
    return relate.series_ids(areas, "code", ["152051", "151252", "000000"])


# --- filters -----------------------------------------------------------------------------------


@query("SELECT * FROM customer WHERE c_mktsegment != 'BUILDING' AND c_mktsegment != 'MACHINERY'")
def exclude_keys(spark: SparkSession, folder: str) -> DataFrame:
    customers = table(spark, folder, "customer")
    return relate.exclude_keys(customers, "c_mktsegment", ["BUILDING", "MACHINERY"])


@query(
    """SELECT event_id, user_id, epoch(date_trunc('second', ts))::BIGINT AS seconds,
       date_trunc('second', ts) AS created
    FROM events WHERE ts BETWEEN TIMESTAMP '2024-01-10 00:00:00' AND TIMESTAMP '2024-01-13 11:20:00'"""
)
def epoch_range(spark: SparkSession, folder: str) -> DataFrame:
    """Three hundred thousand seconds up to a given second."""
    events = table(spark, folder, "events")
    chosen = events.where(epoch_between(events, "ts", 1_705_144_800 - 300_000, 1_705_144_800))
    # Whole seconds since the epoch, of a timestamp without zone taken as UTC.
    seconds = F.timestamp_diff("SECOND", F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'"), F.col("ts"))
    created = F.convert_timezone(None, F.lit("UTC"), epoch_to_timestamp("seconds"))
    return chosen.select("event_id", "user_id", seconds.alias("seconds")).withColumn(
        "created", created
    )


def event_questions(spark: SparkSession, folder: str) -> DataFrame:
    """Events as questions of the API: a nested owner, a list of tags."""
    return table(spark, folder, "events").select(
        F.col("event_id").alias("question_id"),
        F.struct(F.col("user_id"), F.col("event_type").alias("user_type")).alias("owner"),
        F.array("event_type", F.substring("props", 2, 3)).alias("tags"),
        F.timestamp_diff(
            "SECOND", F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'"), F.col("ts")
        ).alias("creation_date"),
        F.floor("value").cast("long").alias("score"),
    )


@query(
    """SELECT event_id AS question_id, floor(value)::BIGINT AS score FROM events
    WHERE event_type = 'click' AND floor(value) >= 1
      AND floor(epoch(ts))::BIGINT BETWEEN 1704844800 AND 1705144800"""
)
def questions_tagged(spark: SparkSession, folder: str) -> DataFrame:
    questions = event_questions(spark, folder)
    chosen = relate.questions_tagged(questions, "click", 1_704_844_800, 1_705_144_800)
    return chosen.select("question_id", "score")


# --- joins -------------------------------------------------------------------------------------


@query(
    """SELECT event_id AS question_id, floor(value)::BIGINT AS score, c_custkey AS user_id,
       c_name AS user_link, c_acctbal AS user_creation_date
    FROM events LEFT JOIN customer ON user_id = c_custkey AND c_mktsegment != 'BUILDING'"""
)
def nested_join(spark: SparkSession, folder: str) -> DataFrame:
    """Questions with their owner; owners of one segment are unknown."""
    users = (
        table(spark, folder, "customer")
        # Users of one segment go by other ids here, so that their questions have no known owner.
        .selectExpr(
            "CASE WHEN c_mktsegment = 'BUILDING' THEN -1 - c_custkey ELSE c_custkey END AS user_id",
            "c_name AS link",
            "c_acctbal AS creation_date",
        )
    )
    joined = relate.with_owner(event_questions(spark, folder), users)
    return joined.select("question_id", "score", "user_id", "user_link", "user_creation_date")


@query("SELECT DISTINCT user_id FROM events")
def distinct_keys(spark: SparkSession, folder: str) -> DataFrame:
    return relate.owner_ids(event_questions(spark, folder))


@query(
    """SELECT s_suppkey AS user_id, s_nationkey AS account_id, s_name AS display_name FROM supplier
    UNION ALL
    SELECT c_custkey, c_nationkey, c_name FROM customer
    WHERE c_custkey NOT IN (SELECT s_suppkey FROM supplier)"""
)
def union_users(spark: SparkSession, folder: str) -> DataFrame:
    """Customers are the old users, suppliers the new ones; their columns come in another order."""
    old = table(spark, folder, "customer").selectExpr(
        "c_custkey AS user_id", "c_nationkey AS account_id", "c_name AS display_name"
    )
    new = table(spark, folder, "supplier").selectExpr(
        "s_name AS display_name", "s_suppkey AS user_id", "s_nationkey AS account_id"
    )
    return relate.union_users(old, new)


def price_series(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Series (orders), areas (customers) and items (priorities), with ids equal to their keys.

    The areas of one segment have codes that no series names.
    """
    series = table(spark, folder, "orders").selectExpr(
        "o_orderkey AS dim_series_id",
        "concat('S', o_orderkey) AS series_id",
        "o_custkey AS area_code",
        "o_orderpriority AS item_code",
    )
    area = table(spark, folder, "customer").selectExpr(
        "c_custkey AS dim_area_id",
        "CASE WHEN c_mktsegment = 'FURNITURE' THEN -1 - c_custkey ELSE c_custkey END AS area_code",
    )
    item = table(spark, folder, "orders").selectExpr(
        "CAST(left(o_orderpriority, 1) AS BIGINT) AS dim_item_id", "o_orderpriority AS item_code"
    )
    return series, area, item.distinct()


@query(
    """SELECT o_orderkey AS dim_series_id, c_custkey AS dim_area_id,
       CAST(left(o_orderpriority, 1) AS BIGINT) AS dim_item_id,
       year(l_shipdate)::BIGINT AS year, l_quantity AS value
    FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey AND o_orderstatus != 'P'
      LEFT JOIN customer ON o_custkey = c_custkey AND c_mktsegment != 'FURNITURE'"""
)
def fact_lookup(spark: SparkSession, folder: str) -> DataFrame:
    """Readings (lineitems) with three looked-up ids; some series and some areas are unknown."""
    series, area, item = price_series(spark, folder)
    pending = table(spark, folder, "orders").where("o_orderstatus = 'P'")
    known = series.join(pending, series["dim_series_id"] == pending["o_orderkey"], "left_anti")
    readings = table(spark, folder, "lineitem").selectExpr(
        "concat('S', l_orderkey) AS series_id",
        "CAST(year(l_shipdate) AS BIGINT) AS year",
        "l_quantity AS value",
    )
    return relate.fact_lookup(readings, known, area, item).drop("series_id")


@query(
    """SELECT concat('S', o_orderkey) AS series_id, year(o_orderdate)::BIGINT AS year,
       strftime(o_orderdate, 'M%m') AS period, o_totalprice AS value,
       CASE WHEN o_orderstatus = 'P' THEN o_orderpriority
            ELSE concat(o_orderstatus, ',', o_orderpriority) END AS footnotes
    FROM orders
    UNION ALL
    SELECT concat('S', o_orderkey), year(o_orderdate)::BIGINT - 1, 'M12', o_totalprice / 2, ''
    FROM orders"""
)
def nested_flatten(spark: SparkSession, folder: str) -> DataFrame:
    """A response per order, holding two monthly readings and a yearly one, flattened."""
    documents = table(spark, folder, "orders").selectExpr(
        """named_struct('series', array(named_struct(
             'seriesID', concat('S', o_orderkey),
             'data', array(
               named_struct('year', CAST(year(o_orderdate) AS BIGINT),
                 'period', date_format(o_orderdate, "'M'MM"), 'value', o_totalprice,
                 'footnotes', array(
                   named_struct('text', nullif(o_orderstatus, 'P')),
                   named_struct('text', o_orderpriority))),
               named_struct('year', CAST(year(o_orderdate) AS BIGINT) - 1,
                 'period', 'M12', 'value', o_totalprice / 2,
                 'footnotes', array(named_struct('text', CAST(NULL AS STRING)))),
               named_struct('year', CAST(year(o_orderdate) AS BIGINT),
                 'period', 'M13', 'value', o_totalprice,
                 'footnotes', array(named_struct('text', 'annual')))))))
           AS Results"""
    )
    return relate.flatten_series(documents)


# --- order, pages, counts ----------------------------------------------------------------------


@query(
    """SELECT event_id, ts, (row_number() OVER (ORDER BY ts, event_id) - 1)::BIGINT // 10 AS page
    FROM events"""
)
def keyset_page(spark: SparkSession, folder: str) -> DataFrame:
    events = table(spark, folder, "events").select("event_id", "ts")
    return numbering.with_page(events, ["ts", "event_id"], 10)


@query(
    """SELECT event_id, ts, user_id FROM events WHERE (ts, event_id) >
       (SELECT (ts, event_id) FROM events ORDER BY ts, event_id LIMIT 1 OFFSET 9)
    ORDER BY ts, event_id LIMIT 10"""
)
def keyset_next(spark: SparkSession, folder: str) -> DataFrame:
    """The second page of ten, by the cursor which the first one leaves."""
    events = table(spark, folder, "events").select("event_id", "ts", "user_id")
    first = numbering.next_page(events, ["ts", "event_id"], 10)
    cursor = numbering.page_cursor(first, ["ts", "event_id"])
    return numbering.next_page(events, ["ts", "event_id"], 10, cursor)


@query("SELECT count(*) AS row_count, min(ts) AS first_ts FROM events")
def row_count(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "events").agg(
        F.count(F.lit(1)).alias("row_count"), F.min("ts").alias("first_ts")
    )


def _profile_sql(name: str, numbers: dict[str, bool], texts: list[str], source: str) -> str:
    """``numbers`` maps a column to whether it may hold NaN."""
    rows = []
    for column, fraction in numbers.items():
        valid = f"CASE WHEN isnan({column}) THEN NULL ELSE {column} END" if fraction else column
        text = "NULL" if fraction else "{}(" + column + ")"
        nan = f"count(*) FILTER (WHERE isnan({column}))" if fraction else "0::BIGINT"
        rows.append(
            f"""SELECT '{column}' AS column_name, count(*) AS row_count,
            count(*) FILTER (WHERE {column} IS NULL) AS null_count, {nan} AS nan_count,
            min({valid})::DOUBLE AS min_number, max({valid})::DOUBLE AS max_number,
            {text.format("min")}::VARCHAR AS min_text, {text.format("max")}::VARCHAR AS max_text,
            count(DISTINCT {column}) AS distinct_count FROM {name}"""
        )
    for column in texts:
        rows.append(
            f"""SELECT '{column}', count(*), count(*) FILTER (WHERE {column} IS NULL), 0::BIGINT,
            NULL::DOUBLE, NULL::DOUBLE, min({column})::VARCHAR, max({column})::VARCHAR,
            count(DISTINCT {column}) FROM {name}"""
        )
    return f"{source} " + " UNION ALL ".join(rows)


@query(
    _profile_sql(
        "readings",
        {"event_id": False, "user_id": False, "value": True, "footnote_codes": True},
        ["event_type", "day"],
        """WITH readings AS (
          SELECT event_id, user_id, event_type, ts::DATE AS day,
                 CASE event_type WHEN 'error' THEN NULL WHEN 'signup' THEN 'NaN'::DOUBLE
                      ELSE value END AS value,
                 'NaN'::DOUBLE AS footnote_codes
          FROM events)""",
    )
)
def profile_columns(spark: SparkSession, folder: str) -> DataFrame:
    readings = table(spark, folder, "events").selectExpr(
        "event_id",
        "user_id",
        "event_type",
        "CAST(ts AS DATE) AS day",
        "CASE event_type WHEN 'error' THEN NULL WHEN 'signup' THEN DOUBLE('NaN') ELSE value END AS value",
        "DOUBLE('NaN') AS footnote_codes",
    )
    return profile.profile_columns(readings)


def _key_sql(name: str, key: str, null_key: str) -> str:
    return f"""SELECT sum(copies)::BIGINT AS row_count, count(*) AS key_count,
      count(*) FILTER (WHERE copies > 1) AS repeated_keys,
      coalesce(sum(copies) FILTER (WHERE {null_key}), 0)::BIGINT AS null_key_rows,
      count(*) FILTER (WHERE copies > 1 OR {null_key}) = 0 AS is_key
    FROM (SELECT {key}, count(*) AS copies FROM {name} GROUP BY {key})"""


@query(_key_sql("lineitem", "l_orderkey, l_linenumber", "l_orderkey IS NULL OR l_linenumber IS NULL"))
def key_check(spark: SparkSession, folder: str) -> DataFrame:
    return profile.key_check(table(spark, folder, "lineitem"), ["l_orderkey", "l_linenumber"])


@query(_key_sql("orders", "o_orderkey", "o_orderkey IS NULL"))
def key_check_unique(spark: SparkSession, folder: str) -> DataFrame:
    return profile.key_check(table(spark, folder, "orders"), ["o_orderkey"])


@query()
def table_size(spark: SparkSession, folder: str) -> DataFrame:
    """Sizes on disk are not to be had in SQL over the tables' rows."""
    return profile.table_sizes(spark, folder)


def _candidates_sql(name: str, columns: list[str], most: int) -> str:
    """All sets of up to ``most`` columns, the unique ones, and of those the ones that hold no other."""
    sets = [s for size in range(1, most + 1) for s in itertools.combinations(columns, size)]
    unique = " UNION ALL ".join(
        f"""SELECT {list(s)} AS names WHERE (SELECT count(*) FROM {name}) =
            (SELECT count(*) FROM (SELECT DISTINCT {", ".join(s)} FROM {name}
             WHERE {" AND ".join(c + " IS NOT NULL" for c in s)}))"""
        for s in sets
    )
    return f"""WITH keys AS ({unique})
    SELECT array_to_string(names, ',') AS key_columns, len(names)::INTEGER AS column_count FROM keys k
    WHERE NOT EXISTS (SELECT 1 FROM keys o WHERE o.names != k.names AND list_has_all(k.names, o.names))"""


CANDIDATES = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]


@query(_candidates_sql("orders", CANDIDATES, 3))
def key_candidates(spark: SparkSession, folder: str) -> DataFrame:
    """The minimal business keys of the orders: the id, and what happens to be unique beside it."""
    return profile.key_candidates(table(spark, folder, "orders"), CANDIDATES, 3)


@query(
    """WITH parts AS (SELECT *, CASE WHEN event_type = 'error' THEN NULL ELSE value END AS score FROM events)
    SELECT 'event_id' AS column_name, count(*)::BIGINT AS row_count, 0::BIGINT AS null_count,
           min(event_id)::DOUBLE AS min_number, max(event_id)::DOUBLE AS max_number, TRUE AS distinct_is_near,
           TRUE AS median_is_near FROM parts
    UNION ALL SELECT 'event_type', count(*), 0, NULL, NULL, TRUE, NULL FROM parts
    UNION ALL SELECT 'score', count(*), count(*) - count(score), min(score), max(score), TRUE, TRUE FROM parts
    UNION ALL SELECT 'user_id', count(*), 0, min(user_id), max(user_id), TRUE, TRUE FROM parts"""
)
def profile_incremental(spark: SparkSession, folder: str) -> DataFrame:
    """Events that arrive in three commits, each scanned once; their profile next to that of a full scan."""
    events = table(spark, folder, "events").selectExpr(
        "event_id", "event_type", "user_id", "CASE WHEN event_type = 'error' THEN NULL ELSE value END AS score"
    )
    growing = profile.GrowingProfile(spark, scratch_path(spark, "profile"))
    for commit in range(3):
        growing.add(events.where(F.col("event_id") % 3 == commit), commit)
    growing.add(events.where(F.col("event_id") % 3 == 1), 1)  # once more, as after a failure
    full = profile.profile_columns(events).select("column_name", F.col("distinct_count").alias("exact"))
    numbers = ["event_id", "user_id", "score"]
    # The ranks of the median: the shares of values below it, and not above it.
    middle = {r["column_name"]: r["quantiles"] for r in growing.profile().collect()}
    ranks = events.agg(
        *(F.avg((F.col(c) < middle[c][0]).cast("double")).alias(f"{c}_below") for c in numbers),
        *(F.avg((F.col(c) <= middle[c][0]).cast("double")).alias(f"{c}_upto") for c in numbers),
    ).first()
    near = {c: ranks[f"{c}_below"] <= 0.52 and ranks[f"{c}_upto"] >= 0.48 for c in numbers}
    median = F.coalesce(*(F.when(F.col("column_name") == c, F.lit(v)) for c, v in near.items()))
    close = F.abs(F.col("distinct_count") - F.col("exact")) <= profile.DISTINCT_BOUND * F.col("exact")
    return growing.profile().join(full, "column_name").select(
        "column_name",
        "row_count",
        "null_count",
        "min_number",
        "max_number",
        close.alias("distinct_is_near"),
        median.alias("median_is_near"),
    )
