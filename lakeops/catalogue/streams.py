"""Streaming loads: events arrive as messages in files which carry the broker's envelope."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from lakeops.catalogue import query, table
from lakeops.session import scratch_path
from lakeops.streaming import lifecycle, posts

POST = "_Id long, _OwnerUserId long, _Score double, _Title string"


def event_messages(spark: SparkSession, folder: str) -> str:
    """Events as stored messages; a fifth of them (errors) is not JSON."""
    path = scratch_path(spark, "messages")
    events = table(spark, folder, "events")
    value = F.to_json(
        F.struct(
            F.col("event_id").alias("_Id"),
            F.col("user_id").alias("_OwnerUserId"),
            F.col("value").alias("_Score"),
            F.col("event_type").alias("_Title"),
        )
    )
    broken = F.when(F.col("event_type") == "error", F.lit("not json")).otherwise(value)
    events.select(
        F.lit("posts").alias("topic"),
        F.lit(0).alias("partition"),
        F.col("event_id").alias("offset"),
        F.col("ts").cast("timestamp").alias("timestamp"),
        F.lit(0).alias("timestampType"),
        F.col("event_id").cast("string").cast("binary").alias("key"),
        broken.cast("binary").alias("value"),
    ).write.parquet(path)
    return path


def post_stream(spark: SparkSession, folder: str) -> DataFrame:
    messages = posts.read_messages(spark, {}, "parquet", event_messages(spark, folder))
    return posts.parse_posts(posts.envelope(messages), POST)


def user_sets(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """Old users (customers) and new ones (suppliers); some ids are in both sets."""
    old = table(spark, folder, "customer").selectExpr(
        "c_custkey AS _Id", "c_nationkey AS _AccountId", "c_name AS _DisplayName",
        "c_mktsegment AS _WebsiteUrl",
    )
    new = table(spark, folder, "supplier").selectExpr(
        "s_suppkey AS user_id", "s_nationkey AS account_id", "s_name AS display_name",
        "CAST(NULL AS STRING) AS website_url", "s_acctbal AS reputation",
    )
    return old, new


@query(
    """SELECT event_id::VARCHAR AS key, CASE WHEN event_type != 'error' THEN event_id END AS _Id,
       CASE WHEN event_type != 'error' THEN user_id END AS _OwnerUserId,
       CASE WHEN event_type != 'error' THEN value END AS _Score
    FROM events"""
)
def stream_parse(spark: SparkSession, folder: str) -> DataFrame:
    messages = posts.read_messages(spark, {}, "parquet", event_messages(spark, folder))
    parsed = posts.envelope(messages).select(
        "key", F.from_json(F.col("value").cast("string"), POST).alias("json")
    ).select("key", "json.*").drop("_Title")
    target = scratch_path(spark, "parsed")
    posts.append_stream(parsed, target, scratch_path(spark, "offsets"), once=True).awaitTermination()
    return spark.read.parquet(target)


USERS_SQL = """
users AS (
  SELECT s_suppkey AS user_id, s_nationkey AS account_id, s_name AS display_name,
         NULL::VARCHAR AS website_url FROM supplier
  UNION ALL
  SELECT c_custkey, c_nationkey, c_name, c_mktsegment FROM customer
  WHERE c_custkey NOT IN (SELECT s_suppkey FROM supplier))"""
POSTS_SQL = """
posts AS (
  SELECT CASE WHEN event_type != 'error' THEN event_id END AS _Id,
         CASE WHEN event_type != 'error' THEN user_id END AS _OwnerUserId,
         CASE WHEN event_type != 'error' THEN value END AS _Score,
         CASE WHEN event_type != 'error' THEN event_type END AS _Title FROM events)"""
ENRICHED_SQL = f"""WITH {USERS_SQL}, {POSTS_SQL}
SELECT * FROM posts LEFT JOIN users ON _OwnerUserId = user_id"""


@query(ENRICHED_SQL)
def stream_enrich(spark: SparkSession, folder: str) -> DataFrame:
    users = posts.all_users(*user_sets(spark, folder))
    enriched = posts.with_users(post_stream(spark, folder), users)
    target = scratch_path(spark, "enriched")
    run = posts.append_stream(enriched, target, scratch_path(spark, "offsets"), once=True)
    run.awaitTermination()
    return spark.read.parquet(target)


@query(ENRICHED_SQL)
def stream_enrich_fresh(spark: SparkSession, folder: str) -> DataFrame:
    """The same, with the users read again for each batch."""
    target = scratch_path(spark, "enriched")
    run = posts.append_with_fresh_users(
        post_stream(spark, folder),
        lambda: posts.all_users(*user_sets(spark, folder)),
        target,
        scratch_path(spark, "offsets"),
        once=True,
    )
    run.awaitTermination()
    return spark.read.parquet(target).drop("batch_id")


@query(ENRICHED_SQL)
def batch_enrich(spark: SparkSession, folder: str) -> DataFrame:
    """The same functions over a batch of messages."""
    messages = spark.read.schema(posts.ENVELOPE).parquet(event_messages(spark, folder))
    users = posts.all_users(*user_sets(spark, folder))
    return posts.with_users(posts.parse_posts(posts.envelope(messages), POST), users)


DEAD_LETTERS_SQL = """SELECT event_id AS _Id, event_type = 'error' AS is_dead,
  CASE WHEN event_type != 'error' THEN value END AS _Score,
  CASE WHEN event_type = 'error' THEN 'malformed' END AS reason FROM events"""


@query(DEAD_LETTERS_SQL)
def stream_dead_letters(spark: SparkSession, folder: str) -> DataFrame:
    """Readable messages in one table, unreadable ones beside it, from the same micro-batches."""
    messages = posts.envelope(posts.read_messages(spark, {}, "parquet", event_messages(spark, folder)))
    good, dead, seen = scratch_path(spark, "posts"), scratch_path(spark, "dead-letters"), []
    posts.append_with_dead_letters(
        messages, good, dead, scratch_path(spark, "offsets"), POST, "_Id", once=True,
        counts=lambda batch, counted: seen.append(counted),
    ).awaitTermination()
    kept = spark.read.parquet(good).selectExpr("_Id", "false AS is_dead", "_Score", "CAST(NULL AS STRING) AS reason")
    lost = spark.read.parquet(dead).selectExpr(
        "CAST(key AS BIGINT) AS _Id", "true AS is_dead", "CAST(NULL AS DOUBLE) AS _Score", "reason"
    )
    both = kept.unionByName(lost)
    total = sum(c["readable"] + c["unreadable"] for c in seen)
    if total != both.count():
        raise ValueError(f"{total} messages were counted while writing, but {both.count()} were written")
    return both


@query(
    """SELECT event_id AS _Id, 1::BIGINT AS times FROM events WHERE event_type != 'error'
    UNION ALL SELECT NULL, count(*) FROM events WHERE event_type = 'error'"""
)
def stream_restart(spark: SparkSession, folder: str) -> DataFrame:
    """Messages arrive in two parts; the stream is drained, stopped and started again from its checkpoint.

    Each message is stored once.
    """
    stored = spark.read.schema(posts.ENVELOPE).parquet(event_messages(spark, folder))
    arriving, target, offsets = (scratch_path(spark, n) for n in ("arriving", "posts", "offsets"))
    first = F.pmod(F.xxhash64("offset"), F.lit(3)) > 0
    with lifecycle.watching(spark) as watch:
        for part in (first, ~first):
            stored.where(part).write.mode("append").parquet(arriving)
            parsed = posts.parse_posts(posts.envelope(posts.read_messages(spark, {}, "parquet", arriving)), POST)
            run = posts.append_stream(parsed, target, offsets, every="1 second")
            lifecycle.stop(run)
            if watch.wait_ended(run, 30).error:
                raise RuntimeError(watch.progress(run).error)
    return spark.read.parquet(target).groupBy("_Id").agg(F.count("*").alias("times"))
