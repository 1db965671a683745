"""Files, catalog tables and versioned tables. Whatever is written goes to a new scratch folder."""

from __future__ import annotations

import math
import uuid
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F

from lakeops.catalogue import query, table
from lakeops.catalogue.maintenance import (
    BOTH_SQL,
    COMMITTED,
    DIFFERS,
    FLAG,
    KEY,
    ORDER_COLUMNS,
    SYNC_SQL,
    flagged_source,
    source_orders,
    target_orders,
)
from lakeops.catalogue.relational import event_questions, events_as_posts
from lakeops.functions import key_value_messages, month_start
from lakeops.operators import changes
from lakeops.plans import ingest, replay
from lakeops.session import scratch_path
from lakeops.sources import files
from lakeops.sources.writers import append_evolving, overwrite, overwrite_table, send_messages
from lakeops.tables import catalog
from lakeops.tables.versioned import VersionedTable

SECOND_COMMIT = datetime(2022, 3, 2, 10, 0, 0)
THIRD_COMMIT = datetime(2022, 3, 3, 10, 0, 0)


@query("SELECT * FROM orders")
def parquet_overwrite(spark: SparkSession, folder: str) -> DataFrame:
    """The second write replaces the first one."""
    path = scratch_path(spark, "orders")
    overwrite(target_orders(spark, folder), path)
    overwrite(table(spark, folder, "orders"), path)
    catalog.refresh(spark, path)
    return files.read_table(spark, path)


@query(
    """SELECT o_orderkey, o_totalprice, strftime(o_orderdate, '%Y-%m-01') AS order_month
    FROM orders WHERE strftime(o_orderdate, '%Y-%m-01') = '1998-06-01'"""
)
def month_partition(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "orders-by-month")
    orders = table(spark, folder, "orders")
    overwrite(orders.withColumn("order_month", month_start("o_orderdate")), path, ["order_month"])
    month = files.read_month(spark, path, "1998-06-01", "order_month")
    return month.select("o_orderkey", "o_totalprice", F.col("order_month").cast("string"))


@query("SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def catalog_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    """Create a database and a typed table, fill it, replace a second table, drop the first."""
    database = f"lakeops_{uuid.uuid4().hex}"
    catalog.create_database(spark, database, scratch_path(spark, "database"))
    customers = table(spark, folder, "customer")
    typed, copied = f"{database}.typed", f"{database}.copied"
    catalog.drop_table(spark, typed)
    catalog.create_table(spark, typed, customers.schema)
    if "c_acctbal DOUBLE" not in catalog.create_statement(spark, typed):
        raise AssertionError("the table lost its types")
    customers.write.insertInto(typed)
    overwrite_table(spark.table(typed), copied, ["c_mktsegment"])
    catalog.drop_table(spark, typed)
    return spark.table(copied).select(*customers.columns)


@query(
    """SELECT c_custkey, c_name, CASE WHEN c_mktsegment = 'BUILDING' THEN NULL ELSE c_acctbal END
    AS c_acctbal FROM customer"""
)
def schema_evolve(spark: SparkSession, folder: str) -> DataFrame:
    """The first append lacks a column which the second one brings."""
    path = scratch_path(spark, "customers")
    customers = table(spark, folder, "customer")
    building = F.col("c_mktsegment") == "BUILDING"
    append_evolving(customers.where(building).select("c_custkey", "c_name"), path)
    append_evolving(customers.where(~building).select("c_custkey", "c_name", "c_acctbal"), path)
    return files.read_evolved(spark, path).select("c_custkey", "c_name", "c_acctbal")


# --- versioned tables --------------------------------------------------------------------------


def orders_table(spark: SparkSession, folder: str) -> VersionedTable:
    """Orders by status: the target, brought in line with the source by a second commit."""
    orders = VersionedTable(spark, scratch_path(spark, "orders"))
    orders.create(target_orders(spark, folder), ["o_orderstatus"], COMMITTED)
    orders.sync(source_orders(spark, folder), KEY, SECOND_COMMIT)
    return orders


@query(
    f"""{BOTH_SQL}, {SYNC_SQL}
    SELECT *, 0::BIGINT AS version FROM target UNION ALL SELECT *, 1::BIGINT FROM synced"""
)
def versioned_read(spark: SparkSession, folder: str) -> DataFrame:
    """Both versions of the table; the newest is found by its name in the catalog."""
    root = scratch_path(spark, "refined")
    database = f"lakeops_{uuid.uuid4().hex}"
    catalog.create_database(spark, database, root)
    orders = VersionedTable.for_name(spark, f"{database}.orders")
    orders.create(target_orders(spark, folder), ["o_orderstatus"], COMMITTED)
    orders.sync(source_orders(spark, folder), KEY, SECOND_COMMIT)
    newest = VersionedTable(spark, f"{root}/orders").read()
    return orders.read(0).withColumn("version", F.lit(0).cast("long")).unionByName(
        newest.withColumn("version", F.lit(1).cast("long"))
    )


HISTORY_SQL = f"""
counted AS (
  SELECT count(*) FILTER (WHERE t.o_orderkey IS NULL) AS inserted,
         count(*) FILTER (WHERE t.o_orderkey IS NOT NULL AND
           CASE WHEN s.o_orderkey IS NULL THEN NOT t.is_deleted ELSE {DIFFERS} END) AS updated
  FROM target t FULL OUTER JOIN source s ON t.o_orderkey = s.o_orderkey)"""


@query(
    f"""{BOTH_SQL}, {HISTORY_SQL}
    SELECT 0::BIGINT AS version, 'create' AS operation, count(*) AS inserted,
           0::BIGINT AS updated, 0::BIGINT AS deleted FROM target
    UNION ALL SELECT 1::BIGINT, 'sync', inserted, updated, 0::BIGINT FROM counted"""
)
def version_history(spark: SparkSession, folder: str) -> DataFrame:
    return orders_table(spark, folder).history().drop("committed_at")


@query(f"{BOTH_SQL}, {SYNC_SQL} SELECT 1::BIGINT AS newest, count(*) AS row_count FROM synced")
def no_changes(spark: SparkSession, folder: str) -> DataFrame:
    """The same extract again: no commit, and no error."""
    orders = orders_table(spark, folder)
    if orders.sync(source_orders(spark, folder), KEY, THIRD_COMMIT) is not None:
        raise AssertionError("an unchanged extract made a commit")
    newest = orders.state().version
    if not orders.changes(newest + 1).isEmpty():
        raise AssertionError("the feed goes on behind the newest version")
    return orders.read().agg(
        F.lit(newest).cast("long").alias("newest"), F.count(F.lit(1)).alias("row_count")
    )


@query(f"{BOTH_SQL} SELECT *, 0::BIGINT AS version FROM source")
def first_load(spark: SparkSession, folder: str) -> DataFrame:
    """The first synchronisation creates the table."""
    orders = VersionedTable(spark, scratch_path(spark, "orders"))
    version = orders.sync(source_orders(spark, folder), KEY, COMMITTED)
    return orders.read().withColumn("version", F.lit(version).cast("long"))


@query(
    f"""{BOTH_SQL}
    SELECT *, 'delete' AS _change_type, 1::BIGINT AS _commit_version FROM target
    UNION ALL SELECT *, 'insert', 1::BIGINT FROM source"""
)
def tracked_overwrite(spark: SparkSession, folder: str) -> DataFrame:
    """The feed of an overwrite."""
    orders = VersionedTable(spark, scratch_path(spark, "orders"))
    orders.overwrite(target_orders(spark, folder), ["o_orderstatus"], COMMITTED)
    orders.overwrite(flagged_source(spark, folder), committed_at=SECOND_COMMIT)
    return orders.changes(1).drop(changes.COMMIT_TIME)


@query(
    f"""{BOTH_SQL}, {SYNC_SQL},
    pairs AS (
      SELECT t.o_orderkey AS old_key, t.o_totalprice AS old_price, t.is_deleted AS old_deleted, s.*
      FROM synced s LEFT JOIN target t ON t.o_orderkey = s.o_orderkey
      WHERE t.o_orderkey IS NULL OR {DIFFERS})
    SELECT o_orderkey, o_totalprice, is_deleted, 'insert' AS _change_type, 1::BIGINT AS _commit_version
    FROM pairs WHERE old_key IS NULL
    UNION ALL
    SELECT o_orderkey, o_totalprice, is_deleted, 'update_postimage', 1 FROM pairs WHERE old_key IS NOT NULL
    UNION ALL
    SELECT o_orderkey, old_price, old_deleted, 'update_preimage', 1 FROM pairs WHERE old_key IS NOT NULL"""
)
def feed_since(spark: SparkSession, folder: str) -> DataFrame:
    """The stored feed from the time of the second commit on."""
    feed = orders_table(spark, folder).changes(since=SECOND_COMMIT)
    return feed.select(
        "o_orderkey", "o_totalprice", FLAG, changes.CHANGE_TYPE, changes.VERSION
    )


@query(f"{BOTH_SQL}, {SYNC_SQL} SELECT * FROM synced")
def feed_replay(spark: SparkSession, folder: str) -> DataFrame:
    """The table rebuilt from its whole feed."""
    feed = orders_table(spark, folder).changes(0)
    return changes.replayed(feed, KEY).select(*ORDER_COLUMNS, FLAG)


# --- ingest ------------------------------------------------------------------------------------


@query(
    """SELECT event_id AS _Id, user_id AS _OwnerUserId, concat('<', event_type, '>|<', user_id, '>')
         AS TagsText, date_trunc('millisecond', ts) AS _CreationDate,
       strftime(ts, '%Y-%m-01') AS CreationMonth,
       CASE WHEN event_type = 'error' THEN NULL
            ELSE strftime(ts + INTERVAL 20 DAY, '%Y-%m-01') END AS LastEditMonth
    FROM events"""
)
def xml_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    """Events as an XML dump of posts, then the dump as a table partitioned by month."""
    dump, target = scratch_path(spark, "posts-xml"), scratch_path(spark, "posts")
    pattern = "yyyy-MM-dd'T'HH:mm:ss.SSS"
    posts = events_as_posts(spark, folder)
    dates = ["_CreationDate", "_LastEditDate", "_LastActivityDate"]
    texts = posts.withColumns({c: F.date_format(c, pattern) for c in dates})
    texts.write.format("xml").option("rootTag", "posts").option("rowTag", "row").save(dump)
    schema = (
        "_Id long, _OwnerUserId long, _Tags string, _Score double, _CreationDate timestamp_ntz, "
        "_LastEditDate timestamp_ntz, _LastActivityDate timestamp_ntz"
    )
    ingest.ingest_xml(spark, dump, "posts", target, schema=schema)
    return files.read_table(spark, target).select(
        "_Id",
        "_OwnerUserId",
        F.array_join("TagsArray", "|").alias("TagsText"),
        "_CreationDate",
        F.col("CreationMonth").cast("string"),
        "LastEditMonth",
    )


ORDERS_XML_SQL = """SELECT o_orderkey AS _Id, CASE WHEN o_orderkey % 5 != 0 THEN o_totalprice END AS _Price,
  CASE WHEN o_orderkey % 1000 = 1 THEN o_custkey END AS _Rare,
  CASE WHEN o_orderkey % 3 = 0 THEN '' ELSE 'it''s "' || o_orderpriority || '" <b=''1''>' END AS _Note,
  CASE WHEN o_orderkey % 7 != 0 THEN o_orderdate END AS _Placed, o_orderstatus = 'O' AS _IsOpen
FROM orders"""


@query(ORDERS_XML_SQL)
def xml_inferred(spark: SparkSession, folder: str) -> DataFrame:
    """Orders as an XML dump without a schema: rare, empty and single-quoted attributes."""
    dump, target = scratch_path(spark, "orders-xml"), scratch_path(spark, "orders")
    orders, key = table(spark, folder, "orders"), F.col("o_orderkey")
    note = F.when(key % 3 == 0, "").otherwise(
        F.concat(F.lit("it's &quot;"), "o_orderpriority", F.lit("&quot; &lt;b='1'&gt;"))
    )
    placed = F.when(key % 7 != 0, F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss.SSS")).otherwise("")
    price = F.when(key % 5 != 0, F.col("o_totalprice").cast("string")).otherwise("")
    line = F.concat(
        F.format_string("  <row Id=\"%d\" Price='%s' Note=\"%s\" ", key, price, note),
        F.when(key % 1000 == 1, F.format_string("Rare='%d' ", "o_custkey")).otherwise(""),
        F.format_string("Placed = \"%s\" IsOpen='%s'/>", placed, (F.col("o_orderstatus") == "O").cast("string")),
    )
    frame = spark.createDataFrame([("<?xml version='1.0'?>",), ("<orders>",), ("</orders>",)], "value string")
    orders.select(line.alias("value")).unionByName(frame).write.text(dump)
    ingest.ingest_xml(spark, dump, "orders", target)
    return files.read_table(spark, target)


def landed_questions(spark: SparkSession, folder: str) -> str:
    """Events as landed API responses, one question each."""
    path = scratch_path(spark, "questions")
    questions = event_questions(spark, folder)
    questions.select(
        F.array(F.struct("*")).alias("items"),
        (F.col("score") > 50).alias("has_more"),
        F.lit(300).alias("quota_max"),
        F.col("question_id").alias("quota_remaining"),
    ).write.json(path)
    return path


QUESTION = (
    "question_id bigint, owner struct<user_id:bigint,user_type:string>, tags array<string>, "
    "creation_date bigint, score bigint"
)
QUESTION_ITEM = QUESTION.replace(" bigint", ":bigint").replace("owner struct", "owner:struct").replace(
    "tags array", "tags:array"
)


@query(
    """SELECT event_id AS question_id, user_id, event_type AS first_tag,
       floor(epoch(ts))::BIGINT AS creation_date, floor(value)::BIGINT AS score FROM events"""
)
def json_landing(spark: SparkSession, folder: str) -> DataFrame:
    pages = files.read_pages(spark, landed_questions(spark, folder), QUESTION_ITEM)
    return files.page_items(pages).select(
        "question_id",
        F.col("owner.user_id").alias("user_id"),
        F.col("tags")[0].alias("first_tag"),
        "creation_date",
        "score",
    )


@query(
    """SELECT event_id AS question_id, user_id, floor(value)::BIGINT AS score,
       CASE WHEN event_id % 4 = 1 THEN 'bronze' END AS badge,
       CASE WHEN event_id % 1000 = 7 THEN event_type END AS note,
       CASE WHEN event_id % 3 = 0 THEN NULL ELSE event_id END AS quota
    FROM events WHERE event_id % 50 != 49"""
)
def json_variant(spark: SparkSession, folder: str) -> DataFrame:
    """Responses whose fields differ, one question each, read once without a schema.

    Some owners have a badge, a few questions a note, a third of the responses no quota; one in fifty is
    an error without items.
    """
    path, key = scratch_path(spark, "responses"), F.col("event_id")
    owner = F.when(
        key % 4 == 1, F.to_json(F.struct("user_id", F.lit("bronze").alias("badge")))
    ).otherwise(F.to_json(F.struct("user_id")))
    question = F.concat(
        F.format_string('{"question_id": %d, "score": %d, "owner": ', key, F.floor("value")),
        owner,
        F.when(key % 1000 == 7, F.format_string(', "note": "%s"', "event_type")).otherwise(""),
        F.lit("}"),
    )
    response = F.when(key % 50 == 49, F.lit('{"error_id": 502, "error_name": "throttle"}')).otherwise(
        F.concat(
            F.lit('{"items": ['),
            question,
            F.lit("]"),
            F.when(key % 3 == 0, "").otherwise(F.format_string(', "quota_remaining": %d', key)),
            F.lit("}"),
        )
    )
    table(spark, folder, "events").select(response.alias("value")).write.text(path)
    pages = files.read_variant_pages(spark, path)
    quota = F.try_variant_get("response", "$.quota_remaining", "bigint")
    items = files.variant_items(pages).select("item")
    found = files.variant_fields(
        items,
        "item",
        {"question_id": "bigint", "owner.user_id": "bigint", "score": "bigint", "owner.badge": "string", "note": "string"},
    )
    quotas = pages.select(
        F.try_variant_get("response", "$.items[0].question_id", "bigint").alias("question_id"), quota.alias("quota")
    )
    return found.join(quotas, "question_id", "left")


@query(
    """SELECT floor(value) > 50 AS has_more, 300::BIGINT AS quota_max, event_id AS quota_remaining
    FROM events"""
)
def json_metadata(spark: SparkSession, folder: str) -> DataFrame:
    return files.page_metadata(
        files.read_pages(spark, landed_questions(spark, folder), QUESTION_ITEM)
    )


@query(
    """SELECT event_id AS question_id, user_id AS owner_id, c_custkey AS user_id, c_name AS user_link
    FROM events LEFT JOIN customer ON user_id = c_custkey AND c_mktsegment != 'BUILDING'"""
)
def answers_ingest(spark: SparkSession, folder: str) -> DataFrame:
    """Landed questions and users, appended with the owner's columns beside the question's."""
    pages = files.read_pages(spark, landed_questions(spark, folder), QUESTION_ITEM)
    users = (
        table(spark, folder, "customer")
        # Users of one segment go by other ids here, so that their questions have no known owner.
        .selectExpr(
            "CASE WHEN c_mktsegment = 'BUILDING' THEN -1 - c_custkey ELSE c_custkey END AS user_id",
            "c_name AS link",
            "c_acctbal AS creation_date",
        )
    )
    users_path, questions_path = scratch_path(spark, "users"), scratch_path(spark, "answers")
    ingest.ingest_answers(files.page_items(pages), users, users_path, questions_path)
    return files.read_evolved(spark, questions_path).select(
        "question_id", F.col("owner.user_id").alias("owner_id"), "user_id", "user_link"
    )


@query("SELECT concat(o_orderkey, '|', o_orderpriority) AS value FROM orders")
def text_lines(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "lines")
    lines = table(spark, folder, "orders").select(F.concat_ws("|", "o_orderkey", "o_orderpriority"))
    lines.write.text(path)
    return files.read_lines(spark, path)


@query(
    """SELECT 'customer' AS table_name, count(*) AS row_count, sum(c_custkey)::BIGINT AS key_sum FROM customer
    UNION ALL SELECT 'orders', count(*), sum(o_orderkey)::BIGINT FROM orders
    UNION ALL SELECT 'part', count(*), sum(p_partkey)::BIGINT FROM part"""
)
def folder_ingest(spark: SparkSession, folder: str) -> DataFrame:
    """Three folders become three versioned tables, one of them partitioned."""
    landing, raw = scratch_path(spark, "landing"), scratch_path(spark, "raw")
    keys = {"customer": "c_custkey", "orders": "o_orderkey", "part": "p_partkey"}
    for name in keys:
        overwrite(table(spark, folder, name), f"{landing}/{name}")
    status = ingest.ingest_folders(spark, landing, raw, {"orders": ["o_orderstatus"]}, workers=3)
    result = None
    for name, key in keys.items():
        counted = VersionedTable(spark, f"{raw}/{name}").read().agg(
            F.lit(name).alias("table_name"),
            F.count(F.lit(1)).alias("row_count"),
            F.sum(key).alias("key_sum"),
        )
        result = counted if result is None else result.unionByName(counted)
    return result.join(status.where("succeeded").select("table_name"), "table_name", "left_semi")


@query(
    """SELECT event_id::VARCHAR AS key,
       (row_number() OVER (ORDER BY ts, event_id) - 1)::BIGINT // 10 AS page,
       event_id AS _Id, user_id AS _OwnerUserId
    FROM events WHERE strftime(ts, '%Y-%m-01') = '2024-01-01'"""
)
def replay_pages(spark: SparkSession, folder: str) -> DataFrame:
    """A month of posts as paged messages; the month holds all events."""
    path = scratch_path(spark, "posts")
    overwrite(ingest.enrich_posts(events_as_posts(spark, folder)), path, [ingest.MONTH])
    messages = ingest.replay_month(spark.read.parquet(path), "2024-01-01")
    post = F.from_json("value", "_Id long, _OwnerUserId long").alias("post")
    return messages.select("key", "page", post).select("key", "page", "post.*")


@query(
    """WITH pages AS (
      SELECT event_id, (row_number() OVER (ORDER BY ts, event_id) - 1)
             // ceil((SELECT count(*) FROM events) / 20.0)::BIGINT AS page FROM events)
    SELECT event_id::VARCHAR AS key, page, CASE WHEN page = 7 THEN 2 ELSE 1 END AS tries FROM pages"""
)
def replay_sent(spark: SparkSession, folder: str) -> DataFrame:
    """Twenty pages of posts handed to a sink that fails once in the middle; each message arrives once."""
    path, target = scratch_path(spark, "posts"), scratch_path(spark, "sent")
    posts = events_as_posts(spark, folder)
    overwrite(ingest.enrich_posts(posts), path, [ingest.MONTH])
    messages = ingest.replay_month(spark.read.parquet(path), "2024-01-01", math.ceil(posts.count() / 20))
    hand_over, store, tries = replay.Replay(spark, scratch_path(spark, "replay")), replay.folder_sink(target), {}

    def sink(rows: DataFrame, page: int) -> None:
        tries[page] = tries.get(page, 0) + 1
        store(rows, page)
        if page == 7 and tries[page] == 1:
            raise ConnectionError("the answer was lost")

    hand_over.prepare(messages)
    try:
        hand_over.send(sink, attempts=1)
    except ConnectionError:
        hand_over.send(sink, attempts=1)
    count = F.create_map(*(F.lit(x) for page, n in tries.items() for x in (page, n)))
    sent = spark.read.parquet(target).select("key", F.col("page").cast("long").alias("page"))
    return sent.withColumn("tries", F.try_element_at(count, F.col("page").cast("int")))


@query("SELECT event_id::VARCHAR AS key, event_id, user_id, value FROM events")
def message_sink(spark: SparkSession, folder: str) -> DataFrame:
    """Events handed to a batch sink as key and value, in two batches, and read back."""
    path, events = scratch_path(spark, "topic"), table(spark, folder, "events")
    messages = key_value_messages(events.select("event_id", "user_id", "value"), "event_id")
    for part in (F.col("key").cast("long") % 2 == 0, F.col("key").cast("long") % 2 != 0):
        send_messages(messages.where(part), {"path": path}, "parquet")
    fields = F.from_json("value", "event_id long, user_id long, value double").alias("fields")
    return spark.read.parquet(path).select("key", fields).select("key", "fields.*")


@query(f"{BOTH_SQL} SELECT * FROM source")
def replay_after_overwrite(spark: SparkSession, folder: str) -> DataFrame:
    """A table rebuilt from a feed that goes across an overwrite with rows in another order."""
    orders = VersionedTable(spark, scratch_path(spark, "orders"))
    orders.overwrite(target_orders(spark, folder), committed_at=COMMITTED)
    orders.overwrite(flagged_source(spark, folder).repartition(5, "o_custkey"), committed_at=SECOND_COMMIT)
    return changes.replayed(orders.changes(0), KEY).select(*ORDER_COLUMNS, FLAG)
