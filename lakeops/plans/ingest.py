"""Raw ingest: databases, folders, XML dumps and landed API responses."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F

from lakeops.functions.text import tag_array
from lakeops.functions.time import month_start
from lakeops.operators.numbering import with_page
from lakeops.operators.relate import USER_NAMES, with_owner
from lakeops.plans.jobs import run_tables
from lakeops.sources import jdbc
from lakeops.sources.files import read_xml, table_folders
from lakeops.sources.writers import append_evolving, overwrite, overwrite_table
from lakeops.tables.versioned import VersionedTable

MONTH = "CreationMonth"


def ingest_database(
    spark: SparkSession,
    connection: Mapping[str, str],
    database: str,
    tables: Sequence[str] | None = None,
    split_by: Mapping[str, tuple[str, int]] | None = None,
    workers: int = 3,
    read: Callable[[str], DataFrame] | None = None,
) -> DataFrame:
    """Copy every table of a source database into catalog tables; one status row per table.

    ``split_by`` maps a table to a column and a number of ranges read side by side; a table without
    an entry is read through one connection.
    """
    names = jdbc.list_tables(spark, connection) if tables is None else tables

    def read_whole(name: str) -> DataFrame:
        column, partitions = (split_by or {}).get(name, (None, 1))
        return jdbc.read_table(spark, connection, name, column, partitions)

    def load(name: str) -> None:
        overwrite_table((read or read_whole)(name), f"{database}.{name}")

    return run_tables(spark, names, load, workers)


def ingest_folders(
    spark: SparkSession,
    source_root: str,
    raw_root: str,
    partition_columns: Mapping[str, Sequence[str]] | None = None,
    committed_at: datetime | None = None,
    workers: int = 1,
) -> DataFrame:
    """Copy each folder of a root into a versioned table of its name."""
    paths = {name: path for path, name in table_folders(spark, source_root)}

    def load(name: str) -> int:
        rows = spark.read.parquet(paths[name])
        table = VersionedTable(spark, f"{raw_root}/{name}")
        return table.overwrite(rows, (partition_columns or {}).get(name), committed_at)

    return run_tables(spark, paths, load, workers)


def enrich_posts(posts: DataFrame) -> DataFrame:
    """Posts with their tags as an array and the months of their dates."""
    return posts.select(
        "*",
        tag_array("_Tags").alias("TagsArray"),
        month_start("_CreationDate").alias(MONTH),
        month_start("_LastEditDate").alias("LastEditMonth"),
        month_start("_LastActivityDate").alias("LastActivityMonth"),
    )


def ingest_xml(spark: SparkSession, path: str, table: str, target: str, schema=None, **options) -> None:
    """An XML dump as Parquet; posts are enriched and partitioned by month of creation."""
    rows = read_xml(spark, path, table, schema=schema, **options)
    if table == "posts":
        overwrite(enrich_posts(rows), target, [MONTH])
    else:
        overwrite(rows, target)


def ingest_answers(
    questions: DataFrame, users: DataFrame, users_path: str, questions_path: str
) -> None:
    """Append landed users, and landed questions with their owner."""
    append_evolving(users.withColumnsRenamed(USER_NAMES), users_path)
    append_evolving(with_owner(questions, users), questions_path)


def replay_month(posts: DataFrame, month: str, page_size: int = 10) -> DataFrame:
    """The posts of a month as keyed messages, each with its page in the order of creation."""
    chosen = posts.where(F.col(MONTH).cast("string") == month)
    paged = with_page(chosen, ["_CreationDate", "_Id"], page_size)
    whole = F.struct(*[c for c in paged.columns if c != "page"])
    return paged.select(
        "page", F.col("_Id").cast("string").alias("key"), F.to_json(whole).alias("value")
    )
