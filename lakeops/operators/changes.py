"""Change rows: table columns plus kind, version and time of the commit."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, Window, functions as F

from lakeops.functions.change import any_changed
from lakeops.operators.merge import INSERT, KEEP, SOFT_DELETE, UPDATE

CHANGE_TYPE = "_change_type"
VERSION = "_commit_version"
COMMIT_TIME = "_commit_timestamp"
FEED_COLUMNS = (CHANGE_TYPE, VERSION, COMMIT_TIME)
# Names of the images in a change feed.
INSERTED = "insert"
BEFORE_UPDATE = "update_preimage"
AFTER_UPDATE = "update_postimage"
DELETED_ROW = "delete"
HARD_DELETE = "delete"


def change_images(pairs: DataFrame) -> DataFrame:
    """One image per inserted or deleted row, two per updated row, none for a kept row."""
    kinds = (
        F.when(F.col("action") == INSERT, F.array(F.lit(INSERTED)))
        .when(
            F.col("action").isin(UPDATE, SOFT_DELETE),
            F.array(F.lit(BEFORE_UPDATE), F.lit(AFTER_UPDATE)),
        )
        .when(F.col("action") == HARD_DELETE, F.array(F.lit(DELETED_ROW)))
    )
    images = pairs.where(F.col("action") != KEEP).select(
        "t", "after", F.explode(kinds).alias(CHANGE_TYPE)
    )
    shows_old = F.col(CHANGE_TYPE).isin(BEFORE_UPDATE, DELETED_ROW)
    columns = [
        F.when(shows_old, F.col(f"t.`{c}`")).otherwise(F.col(f"after.`{c}`")).alias(c)
        for c in pairs.schema["after"].dataType.names
    ]
    return images.select(*columns, CHANGE_TYPE)


def stamped(images: DataFrame, version: int, committed_at: datetime) -> DataFrame:
    """Add version and time of the commit."""
    return images.withColumn(VERSION, F.lit(version).cast("long")).withColumn(
        COMMIT_TIME, F.lit(committed_at).cast("timestamp")
    )


def compare_pairs(before: DataFrame, after: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Pairs of two states of a table, including rows which vanished."""
    old = before.select(*keys, F.struct(*before.columns).alias("t"))
    new = after.select(*keys, F.struct(*[F.col(c) for c in before.columns]).alias("s"))
    compared = [c for c in before.columns if c not in keys]
    action = (
        F.when(F.col("t").isNull(), INSERT)
        .when(F.col("s").isNull(), HARD_DELETE)
        .when(any_changed(compared), UPDATE)
        .otherwise(KEEP)
    )
    joined = old.join(new, list(keys), "full_outer")
    return joined.select("t", action.alias("action"), F.col("s").alias("after"))


def change_rows(
    before: DataFrame, after: DataFrame, keys: Sequence[str], version: int, committed_at: datetime
) -> DataFrame:
    """The change rows of one commit, from the states before and after it."""
    return stamped(change_images(compare_pairs(before, after, keys)), version, committed_at)


def from_version(feed: DataFrame, first: int) -> DataFrame:
    return feed.where(F.col(VERSION) >= first)


def from_time(feed: DataFrame, first: datetime | Column) -> DataFrame:
    """Changes committed at ``first`` or later."""
    first = first if isinstance(first, Column) else F.lit(first)
    return feed.where(F.col(COMMIT_TIME) >= first)


def of_type(feed: DataFrame, *kinds: str) -> DataFrame:
    return feed.where(F.col(CHANGE_TYPE).isin(*kinds))


def as_rows(feed: DataFrame, time_column: str = "last_modified") -> DataFrame:
    """Feed rows as table rows: the commit time gets a name, the other feed columns go."""
    return feed.withColumnRenamed(COMMIT_TIME, time_column).drop(VERSION, CHANGE_TYPE)


def latest_changes(feed: DataFrame, keys: Sequence[str], order: str = VERSION) -> DataFrame:
    """The newest image of each key; images from before an update are dropped.

    An overwrite deletes and inserts a key at one version: there the image that stays wins, whatever
    the order of the rows.

    Spark turns ``row_number() = 1`` into a group limit ahead of the shuffle, so each task sends on
    at most one row per key, however often that key occurs.
    """
    newest = Window.partitionBy(*keys).orderBy(F.desc(order), F.col(CHANGE_TYPE) == DELETED_ROW)
    return (
        feed.where(F.col(CHANGE_TYPE) != BEFORE_UPDATE)
        .withColumn("_newest", F.row_number().over(newest))
        .where(F.col("_newest") == 1)
        .drop("_newest")
    )


def replayed(feed: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The table which a complete feed leads to."""
    rows = latest_changes(feed, keys)
    return rows.where(F.col(CHANGE_TYPE) != DELETED_ROW).drop(*FEED_COLUMNS)
