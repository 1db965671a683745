"""Merge, soft delete, synchronisation, change feed and keys, over ``orders``.

Two extracts of the orders stand in for the target and the source. The target holds what was
placed before 2001, with finished low-priority orders already marked deleted. The source is the
next extract: it lacks the target's open orders of unspecified priority, urgent orders cost one more,
and the priority of pending high-priority orders is no longer known. Each order is in one at least.
"""

from __future__ import annotations

import uuid
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F

from lakeops.catalogue import query, table
from lakeops.functions.change import any_changed, key_condition
from lakeops.functions.time import after_watermark
from lakeops.operators import changes, merge, numbering
from lakeops.session import scratch_path
from lakeops.tables import catalog
from lakeops.tables.bucketed import BucketedTable

ORDER_COLUMNS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority"]
KEY = ["o_orderkey"]
FLAG = merge.DELETED
COMMITTED = datetime(2022, 3, 1, 10, 0, 0)

TARGET_SQL = """
target AS (
  SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority,
         o_orderstatus = 'F' AND o_orderpriority = '5-LOW' AS is_deleted
  FROM orders WHERE o_orderdate < TIMESTAMP '2001-01-01 00:00:00')"""
SOURCE_SQL = """
source AS (
  SELECT o_orderkey, o_custkey, o_orderstatus,
         CASE WHEN o_orderpriority = '1-URGENT' THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice,
         CASE WHEN o_orderstatus = 'P' AND o_orderpriority = '2-HIGH' THEN NULL
              ELSE o_orderpriority END AS o_orderpriority,
         FALSE AS is_deleted
  FROM orders WHERE NOT (o_orderstatus = 'O' AND o_orderpriority = '4-NOT SPECIFIED'
                         AND o_orderdate < TIMESTAMP '2001-01-01 00:00:00'))"""
BOTH_SQL = f"WITH {TARGET_SQL}, {SOURCE_SQL}"
DIFFERS = """(t.o_custkey IS DISTINCT FROM s.o_custkey
   OR t.o_orderstatus IS DISTINCT FROM s.o_orderstatus
   OR t.o_totalprice IS DISTINCT FROM s.o_totalprice
   OR t.o_orderpriority IS DISTINCT FROM s.o_orderpriority
   OR t.is_deleted IS DISTINCT FROM s.is_deleted)"""
DIFFERS_SQLNE = """(t.o_custkey != s.o_custkey OR t.o_orderstatus != s.o_orderstatus
   OR t.o_totalprice != s.o_totalprice OR t.o_orderpriority != s.o_orderpriority
   OR t.is_deleted != s.is_deleted)"""


def target_orders(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders")
    return orders.where("o_orderdate < TIMESTAMP_NTZ'2001-01-01 00:00:00'").select(
        *ORDER_COLUMNS,
        F.expr("o_orderstatus = 'F' AND o_orderpriority = '5-LOW'").alias(FLAG),
    )


def source_orders(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders")
    return orders.where(
        "NOT (o_orderstatus = 'O' AND o_orderpriority = '4-NOT SPECIFIED'"
        " AND o_orderdate < TIMESTAMP_NTZ'2001-01-01 00:00:00')"
    ).select(
        "o_orderkey",
        "o_custkey",
        "o_orderstatus",
        F.expr(
            "CASE WHEN o_orderpriority = '1-URGENT' THEN o_totalprice + 1 ELSE o_totalprice END"
        ).alias("o_totalprice"),
        F.expr(
            "CASE WHEN o_orderstatus = 'P' AND o_orderpriority = '2-HIGH' THEN NULL"
            " ELSE o_orderpriority END"
        ).alias("o_orderpriority"),
    )


SYNC_SQL = """
synced AS (
  SELECT coalesce(t.o_orderkey, s.o_orderkey) AS o_orderkey,
         CASE WHEN s.o_orderkey IS NULL THEN t.o_custkey ELSE s.o_custkey END AS o_custkey,
         CASE WHEN s.o_orderkey IS NULL THEN t.o_orderstatus ELSE s.o_orderstatus END AS o_orderstatus,
         CASE WHEN s.o_orderkey IS NULL THEN t.o_totalprice ELSE s.o_totalprice END AS o_totalprice,
         CASE WHEN s.o_orderkey IS NULL THEN t.o_orderpriority ELSE s.o_orderpriority END AS o_orderpriority,
         s.o_orderkey IS NULL AS is_deleted
  FROM target t FULL OUTER JOIN source s ON t.o_orderkey = s.o_orderkey)"""


@query(f"{BOTH_SQL}, {SYNC_SQL} SELECT * FROM synced")
def sync_full(spark: SparkSession, folder: str) -> DataFrame:
    return merge.sync(target_orders(spark, folder), source_orders(spark, folder), KEY)


@query(f"{BOTH_SQL}, {SYNC_SQL} SELECT * FROM synced")
def sync_bucketed(spark: SparkSession, folder: str) -> DataFrame:
    """The same with the target stored in buckets of its key, which the load leaves where they are."""
    catalog.create_database(spark, "bucketed", scratch_path(spark, "bucketed-db"))
    orders = BucketedTable(spark, f"bucketed.orders_{uuid.uuid4().hex}", KEY, 8)
    orders.create(target_orders(spark, folder))
    orders.sync(source_orders(spark, folder))
    return orders.read()


@query(
    f"""{BOTH_SQL}, {SYNC_SQL},
    second AS (
      SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority,
             o_orderdate >= TIMESTAMP '2001-01-01 00:00:00' AS is_deleted
      FROM orders)
    SELECT t.o_orderkey, s.o_custkey, s.o_orderstatus,
           CASE WHEN s.is_deleted THEN t.o_totalprice ELSE s.o_totalprice END AS o_totalprice,
           CASE WHEN s.is_deleted THEN t.o_orderpriority ELSE s.o_orderpriority END AS o_orderpriority,
           s.is_deleted, t.is_deleted AND NOT s.is_deleted AS revived
    FROM synced t JOIN second s ON t.o_orderkey = s.o_orderkey"""
)
def sync_revive(spark: SparkSession, folder: str) -> DataFrame:
    """A second extract brings back what the first one lacked, and lacks the newest orders."""
    first = sync_full(spark, folder)
    orders = table(spark, folder, "orders")
    extract = orders.where("o_orderdate < TIMESTAMP_NTZ'2001-01-01 00:00:00'").select(*ORDER_COLUMNS)
    pairs = merge.sync_pairs(first, extract, KEY)
    revived = F.coalesce(F.col(f"t.{FLAG}") & ~F.col(f"after.{FLAG}"), F.lit(False))
    return pairs.select("after.*", revived.alias("revived"))


@query(
    f"""{BOTH_SQL}, {SYNC_SQL}
    SELECT 'keep' AS action, count(*) AS row_count FROM synced"""
)
def sync_idempotent(spark: SparkSession, folder: str) -> DataFrame:
    """Synchronising a second time with the same extract keeps every row."""
    pairs = merge.sync_pairs(sync_full(spark, folder), source_orders(spark, folder), KEY)
    return pairs.groupBy("action").agg(F.count(F.lit(1)).alias("row_count"))


@query(
    f"""{BOTH_SQL}
    SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority, TRUE AS is_deleted
    FROM target t WHERE NOT is_deleted
      AND NOT EXISTS (SELECT 1 FROM source s WHERE s.o_orderkey = t.o_orderkey)"""
)
def soft_delete_rows(spark: SparkSession, folder: str) -> DataFrame:
    return merge.soft_deletes(target_orders(spark, folder), source_orders(spark, folder), KEY)


@query(f"WITH {TARGET_SQL} SELECT * FROM target WHERE NOT is_deleted")
def active_rows(spark: SparkSession, folder: str) -> DataFrame:
    return merge.active(target_orders(spark, folder))


def _merge_sql(condition: str) -> str:
    """A merge which updates matches under a condition and inserts the rest."""
    columns = ["o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority", "is_deleted"]
    takes_source = f"t.o_orderkey IS NULL OR (s.o_orderkey IS NOT NULL AND coalesce({condition}, FALSE))"
    chosen = ", ".join(
        f"CASE WHEN {takes_source} THEN s.{c} ELSE t.{c} END AS {c}" for c in columns
    )
    return f"""{BOTH_SQL}
    SELECT coalesce(t.o_orderkey, s.o_orderkey) AS o_orderkey, {chosen}
    FROM target t FULL OUTER JOIN source s ON t.o_orderkey = s.o_orderkey"""


def flagged_source(spark: SparkSession, folder: str) -> DataFrame:
    return source_orders(spark, folder).withColumn(FLAG, F.lit(False))


COMPARED = [c for c in (*ORDER_COLUMNS, FLAG) if c not in KEY]


@query(_merge_sql(DIFFERS))
def merge_conditional(spark: SparkSession, folder: str) -> DataFrame:
    return merge.merge(
        target_orders(spark, folder), flagged_source(spark, folder), KEY, when=any_changed(COMPARED)
    )


@query(_merge_sql(DIFFERS_SQLNE))
def merge_conditional_sqlne(spark: SparkSession, folder: str) -> DataFrame:
    return merge.merge(
        target_orders(spark, folder),
        flagged_source(spark, folder),
        KEY,
        when=any_changed(COMPARED, null_safe=False),
    )


@query(_merge_sql("TRUE"))
def merge_unconditional(spark: SparkSession, folder: str) -> DataFrame:
    return merge.merge(target_orders(spark, folder), flagged_source(spark, folder), KEY)


@query(
    f"""{BOTH_SQL}
    SELECT coalesce(t.o_orderkey, s.o_orderkey) AS o_orderkey,
           coalesce(t.o_custkey, s.o_custkey) AS o_custkey,
           t.o_orderstatus,
           CASE WHEN t.o_orderkey IS NULL THEN s.o_totalprice / (s.o_custkey + 1)
                WHEN s.o_orderstatus = 'F' THEN s.o_totalprice / (t.o_custkey + 1)
                ELSE t.o_totalprice END AS o_totalprice,
           t.o_orderpriority, t.is_deleted
    FROM target t FULL OUTER JOIN source s ON t.o_orderkey = s.o_orderkey"""
)
def merge_expr(spark: SparkSession, folder: str) -> DataFrame:
    """Expressions over both rows; the insert names only some columns."""
    return merge.merge(
        target_orders(spark, folder),
        source_orders(spark, folder),
        KEY,
        update={"o_totalprice": "s.o_totalprice / (t.o_custkey + 1)"},
        when="s.o_orderstatus = 'F'",
        insert={
            "o_orderkey": "s.o_orderkey",
            "o_custkey": "s.o_custkey",
            "o_totalprice": "s.o_totalprice / (s.o_custkey + 1)",
        },
    )


def _changed(spark: SparkSession, folder: str, null_safe: bool) -> DataFrame:
    t = target_orders(spark, folder).alias("t")
    s = flagged_source(spark, folder).alias("s")
    joined = t.join(s, F.expr(key_condition(KEY)))
    return joined.where(any_changed(COMPARED, null_safe)).select("s.*")


@query(
    f"{BOTH_SQL} SELECT s.* FROM target t JOIN source s ON t.o_orderkey = s.o_orderkey WHERE {DIFFERS}"
)
def changed_rows(spark: SparkSession, folder: str) -> DataFrame:
    return _changed(spark, folder, True)


@query(
    f"{BOTH_SQL} SELECT s.* FROM target t JOIN source s ON t.o_orderkey = s.o_orderkey"
    f" WHERE {DIFFERS_SQLNE}"
)
def changed_rows_sqlne(spark: SparkSession, folder: str) -> DataFrame:
    return _changed(spark, folder, False)


@query(
    f"""{BOTH_SQL} SELECT * FROM target t
    WHERE NOT EXISTS (SELECT 1 FROM source s WHERE s.o_orderkey = t.o_orderkey)"""
)
def left_anti_single(spark: SparkSession, folder: str) -> DataFrame:
    return merge.missing_in(target_orders(spark, folder), source_orders(spark, folder), KEY)


@query(
    """SELECT event_id, user_id, event_type, value FROM events e
    WHERE NOT EXISTS (SELECT 1 FROM events x WHERE x.user_id = e.user_id
      AND x.event_type = e.event_type AND x.value > 100)"""
)
def left_anti_composite(spark: SparkSession, folder: str) -> DataFrame:
    """Events of users who never had a large event of the same type: a key of two columns."""
    events = table(spark, folder, "events")
    return merge.missing_in(
        events.select("event_id", "user_id", "event_type", "value"),
        events.where("value > 100"),
        ["user_id", "event_type"],
    )


# --- change feed -------------------------------------------------------------------------------

IMAGES_SQL = f"""
images AS (
  SELECT s.o_orderkey, s.o_custkey, s.o_orderstatus, s.o_totalprice, s.o_orderpriority, s.is_deleted,
         'insert' AS _change_type
  FROM source s WHERE NOT EXISTS (SELECT 1 FROM target t WHERE t.o_orderkey = s.o_orderkey)
  UNION ALL
  SELECT t.o_orderkey, t.o_custkey, t.o_orderstatus, t.o_totalprice, t.o_orderpriority, t.is_deleted,
         'delete'
  FROM target t WHERE NOT EXISTS (SELECT 1 FROM source s WHERE t.o_orderkey = s.o_orderkey)
  UNION ALL
  SELECT t.o_orderkey, t.o_custkey, t.o_orderstatus, t.o_totalprice, t.o_orderpriority, t.is_deleted,
         'update_preimage'
  FROM target t JOIN source s ON t.o_orderkey = s.o_orderkey WHERE {DIFFERS}
  UNION ALL
  SELECT s.o_orderkey, s.o_custkey, s.o_orderstatus, s.o_totalprice, s.o_orderpriority, s.is_deleted,
         'update_postimage'
  FROM target t JOIN source s ON t.o_orderkey = s.o_orderkey WHERE {DIFFERS})"""


def order_changes(spark: SparkSession, folder: str) -> DataFrame:
    """The commit which replaces the target by the source, as version 1."""
    return changes.change_rows(
        target_orders(spark, folder), flagged_source(spark, folder), KEY, 1, COMMITTED
    )


@query(f"{BOTH_SQL}, {IMAGES_SQL} SELECT *, 1::BIGINT AS _commit_version FROM images")
def change_capture(spark: SparkSession, folder: str) -> DataFrame:
    return order_changes(spark, folder).drop(changes.COMMIT_TIME)


@query(f"{BOTH_SQL}, {IMAGES_SQL} SELECT o_orderkey, o_totalprice FROM images WHERE _change_type = 'insert'")
def change_inserts(spark: SparkSession, folder: str) -> DataFrame:
    found = changes.of_type(order_changes(spark, folder), changes.INSERTED)
    return found.select("o_orderkey", "o_totalprice")


# Events read as a feed: the event's day of the month is the version, its user the key.
EVENT_FEED_SQL = """
feed AS (
  SELECT event_id, user_id, value,
         CASE event_type WHEN 'signup' THEN 'insert' WHEN 'view' THEN 'update_preimage'
              WHEN 'error' THEN 'delete' ELSE 'update_postimage' END AS _change_type,
         day(ts)::BIGINT AS _commit_version, ts AS _commit_timestamp
  FROM events)"""


def event_feed(spark: SparkSession, folder: str) -> DataFrame:
    kind = F.expr(
        "CASE event_type WHEN 'signup' THEN 'insert' WHEN 'view' THEN 'update_preimage'"
        " WHEN 'error' THEN 'delete' ELSE 'update_postimage' END"
    )
    return table(spark, folder, "events").select(
        "event_id",
        "user_id",
        "value",
        kind.alias(changes.CHANGE_TYPE),
        F.dayofmonth("ts").cast("long").alias(changes.VERSION),
        F.col("ts").alias(changes.COMMIT_TIME),
    )


@query(
    f"""WITH {EVENT_FEED_SQL}
    SELECT event_id, user_id, value, _commit_timestamp AS last_modified FROM feed
    WHERE _commit_timestamp >= TIMESTAMP '2024-01-15 12:00:00'"""
)
def changes_since(spark: SparkSession, folder: str) -> DataFrame:
    start = F.expr("TIMESTAMP_NTZ'2024-01-15 12:00:00'")
    return changes.as_rows(changes.from_time(event_feed(spark, folder), start))


@query(
    f"""WITH {EVENT_FEED_SQL}
    SELECT event_id, user_id, value, _commit_timestamp AS last_modified FROM feed
    WHERE _commit_version >= 20"""
)
def changes_from_version(spark: SparkSession, folder: str) -> DataFrame:
    return changes.as_rows(changes.from_version(event_feed(spark, folder), 20))


@query(
    f"""WITH {EVENT_FEED_SQL}
    SELECT event_id, user_id, value, _change_type, _commit_version FROM (
      SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY _commit_timestamp DESC) AS place
      FROM feed WHERE _change_type != 'update_preimage') WHERE place = 1"""
)
def latest_changes(spark: SparkSession, folder: str) -> DataFrame:
    newest = changes.latest_changes(event_feed(spark, folder), ["user_id"], changes.COMMIT_TIME)
    return newest.drop(changes.COMMIT_TIME)


@query("SELECT max(ts) + INTERVAL 1 SECOND AS ts FROM events")
def load_watermark(spark: SparkSession, folder: str) -> DataFrame:
    return after_watermark(table(spark, folder, "events"), "ts")


@query(
    """SELECT row_number() OVER (ORDER BY c_custkey)::BIGINT AS dim_customer_id, c_custkey, c_name
    FROM customer"""
)
def identity_keys(spark: SparkSession, folder: str) -> DataFrame:
    customers = table(spark, folder, "customer").select("c_custkey", "c_name")
    return numbering.assign_ids(customers, "dim_customer_id", ["c_custkey"])


@query(
    """WITH known AS (
      SELECT row_number() OVER (ORDER BY c_custkey)::BIGINT AS dim_customer_id, c_custkey
      FROM customer WHERE c_mktsegment = 'BUILDING')
    SELECT * FROM known UNION ALL
    SELECT (row_number() OVER (ORDER BY c_custkey))::BIGINT + (SELECT max(dim_customer_id) FROM known),
           c_custkey
    FROM customer WHERE c_mktsegment != 'BUILDING'"""
)
def identity_keys_next(spark: SparkSession, folder: str) -> DataFrame:
    """Known rows keep their ids, new rows get the numbers after the highest one."""
    customers = table(spark, folder, "customer")
    building = F.col("c_mktsegment") == "BUILDING"
    known = numbering.assign_ids(
        customers.where(building).select("c_custkey"), "dim_customer_id", ["c_custkey"]
    )
    highest = numbering.highest_id(known, "dim_customer_id")
    new = numbering.assign_ids(
        customers.where(~building).select("c_custkey"), "dim_customer_id", ["c_custkey"], highest
    )
    return known.unionByName(new)
