"""Live posts: message stream, parsing, enrichment with users, append to a table."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery
from pyspark.sql.types import StructType

from lakeops.functions.json_text import expand_json
from lakeops.operators.relate import left_join_known, union_users
from lakeops.sources.files import remove_folder

# The message envelope, and the fields of a post message.
ENVELOPE = "topic string, partition int, offset long, timestamp timestamp, timestampType int, key binary, value binary"
POST_SCHEMA = (
    "_Id long, _ParentId long, _PostTypeId long, _Score long, _Tags string, _Title string, "
    "_ViewCount long, _LastActivityDate timestamp, _LastEditDate timestamp, "
    "_LastEditorDisplayName string, _LastEditorUserId long, _OwnerDisplayName string, "
    "_OwnerUserId long, _AcceptedAnswerId long, _AnswerCount long, _Body string, "
    "_ClosedDate timestamp, _CommentCount long, _CommunityOwnedDate timestamp, "
    "_ContentLicense string, _CreationDate timestamp, _FavoriteCount long"
)
# Read a topic from its start, and go on if old messages are gone.
TOPIC_OPTIONS = {"startingOffsets": "earliest", "failOnDataLoss": "false"}
TRIGGER = "30 seconds"


def topic_options(servers: str, topic: str, group: str, **login: str) -> dict[str, str]:
    """Options of a message broker; login options are passed on as they are."""
    # The broker's names of its options.
    return {
        "kafka.bootstrap.servers": servers,
        "kafka.group.id": group,
        "subscribe": topic,
        **TOPIC_OPTIONS,
        **login,
    }


def read_messages(
    spark: SparkSession, options: Mapping[str, str], format: str = "kafka", path: str | None = None
) -> DataFrame:
    """A stream of messages. A file format reads files holding the same envelope."""
    reader = spark.readStream.format(format).options(**options)
    if path is None:
        return reader.load()
    return reader.schema(ENVELOPE).load(path)


def envelope(messages: DataFrame) -> DataFrame:
    """The envelope columns, the key as text."""
    return messages.select(
        "topic", "partition", "offset", "timestamp", "timestampType",
        F.col("key").cast("string").alias("key"), "value",
    )


def parse_posts(messages: DataFrame, schema: StructType | str = POST_SCHEMA) -> DataFrame:
    """One row per message, with the fields of its JSON text."""
    return expand_json(messages, "value", schema)


def split_messages(
    messages: DataFrame, schema: StructType | str = POST_SCHEMA, required: str | None = None
) -> DataFrame:
    """Messages with their fields in ``parsed`` and, where they cannot be read, the ``reason``.

    A message is unreadable if it is empty, is no JSON object, has a value that does not fit its
    field, or lacks the ``required`` field. ``parsed`` is NULL then.
    """
    broken = "_unreadable"
    kind = schema if isinstance(schema, str) else schema.toDDL()
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": broken}
    text = F.col("value").cast("string")
    read = messages.withColumn("_text", text).withColumn(
        "parsed", F.from_json("_text", f"{kind}, `{broken}` string", options)
    )
    reason = F.when(F.col("_text").isNull() | (F.trim("_text") == ""), "empty").when(
        F.col("parsed").isNull() | F.col(f"parsed.{broken}").isNotNull(), "malformed"
    )
    if required is not None:
        reason = reason.when(F.col("parsed").getField(required).isNull(), f"no {required}")
    good = F.col("parsed").dropFields(broken)
    split = read.withColumn("reason", reason)
    return split.withColumn("parsed", F.when(F.col("reason").isNull(), good)).drop("_text")


def append_with_dead_letters(
    messages: DataFrame,
    path: str,
    dead_path: str,
    checkpoint: str,
    schema: StructType | str = POST_SCHEMA,
    required: str | None = None,
    once: bool = False,
    every: str = TRIGGER,
    counts: Callable[[int, Mapping[str, int]], None] | None = None,
) -> StreamingQuery:
    """Append readable messages to one table and the others, as they came, to another.

    Both are written within the same micro-batch: a repeated batch replaces its own folders in both,
    so each message ends up once in one of them. ``counts`` is told the number of readable and
    unreadable messages of each batch, as observed while it is written.
    """

    def store(batch: DataFrame, batch_id: int) -> None:
        seen = Observation(f"batch-{batch_id}")
        split = split_messages(batch, schema, required)
        counted = split.observe(
            seen, F.count_if(F.col("reason").isNull()).alias("readable"), F.count("reason").alias("unreadable")
        )
        # One pass over the batch: the reason is the folder that a message goes to.
        staged = f"{path}/_staged/batch_id={batch_id}"
        counted.withColumn("readable", F.col("reason").isNull()).write.mode("overwrite").partitionBy(
            "readable"
        ).parquet(staged)
        kept = batch.sparkSession.read.schema(counted.withColumn("readable", F.lit(True)).schema).parquet(staged)
        kept.where("readable").select("parsed.*").write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")
        kept.where("NOT readable").drop("parsed", "readable").write.mode("overwrite").parquet(
            f"{dead_path}/batch_id={batch_id}"
        )
        remove_folder(batch.sparkSession, staged)
        if counts is not None:
            counts(batch_id, seen.get)

    writer = messages.writeStream.option("checkpointLocation", checkpoint).foreachBatch(store)
    return _triggered(writer, once, every).start()


def all_users(old: DataFrame, new: DataFrame, dedupe: bool = True) -> DataFrame:
    """Users of the dump and of the API, under the API's names."""
    # The columns of users in the dump and in the API's responses.
    old = old.selectExpr(
        "_Id AS user_id", "_AccountId AS account_id", "_DisplayName AS display_name",
        "_WebsiteUrl AS website_url",
    )
    new = new.select("user_id", "account_id", "display_name", "website_url")
    return union_users(old, new, dedupe)


def with_users(posts: DataFrame, users: DataFrame) -> DataFrame:
    """Posts with the user who owns them, if known. Works for streams and for batches."""
    return left_join_known(posts, users, posts["_OwnerUserId"], users["user_id"])


def _triggered(writer: DataStreamWriter, once: bool, every: str) -> DataStreamWriter:
    return writer.trigger(availableNow=True) if once else writer.trigger(processingTime=every)


def append_stream(
    rows: DataFrame,
    path: str,
    checkpoint: str,
    once: bool = False,
    every: str = TRIGGER,
) -> StreamingQuery:
    """Append a stream to Parquet files, exactly once; ``once`` stops at the end of the input."""
    writer = (
        rows.writeStream.format("parquet")
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
    )
    return _triggered(writer, once, every).start(path)


def append_with_fresh_users(
    posts: DataFrame,
    users: Callable[[], DataFrame],
    path: str,
    checkpoint: str,
    once: bool = False,
    every: str = TRIGGER,
) -> StreamingQuery:
    """As above, but the users are read anew for every batch.

    Each batch is an ordinary join, so adaptive execution picks a broadcast by measured size and
    splits a user who owns a large part of the batch. A repeated batch replaces its own folder.
    """

    def store(batch: DataFrame, batch_id: int) -> None:
        target = f"{path}/batch_id={batch_id}"
        with_users(batch, users()).write.mode("overwrite").parquet(target)

    writer = posts.writeStream.option("checkpointLocation", checkpoint).foreachBatch(store)
    return _triggered(writer, once, every).start()
