"""Joins, unions and reshaping used by the loads."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from lakeops.functions.text import joined_texts


def exclude_keys(df: DataFrame, column: str, values: Sequence) -> DataFrame:
    """Rows whose key is none of the given values; a NULL key is left out, as with SQL ``!=``."""
    return df.where(~F.col(column).isin(*values))


def series_lookup(
    series: DataFrame, area: DataFrame, item: DataFrame
) -> DataFrame:
    """Per series the three dimension ids; area and item are reached through the series."""
    return (
        series.select("series_id", "dim_series_id", "area_code", "item_code")
        .join(area.select("area_code", "dim_area_id"), "area_code", "left")
        .join(item.select("item_code", "dim_item_id"), "item_code", "left")
        .select("series_id", "dim_series_id", "dim_area_id", "dim_item_id")
    )


def fact_lookup(
    changes: DataFrame, series: DataFrame, area: DataFrame, item: DataFrame
) -> DataFrame:
    """Fact changes with their dimension ids; a missing partner leaves a NULL id.

    The dimensions are joined to each other first, so the facts take part in one join only: they
    are shuffled at most once, and adaptive execution may split a series which dominates them.
    """
    ids = series_lookup(series, area, item)
    columns = [c for c in changes.columns if c != "series_id"]
    return changes.join(ids, "series_id", "left").select(
        "series_id", "dim_area_id", "dim_item_id", "dim_series_id", *columns
    )


# The columns that users and their questions both have, and their names behind a join.
USER_NAMES = {"creation_date": "user_creation_date", "link": "user_link"}


def left_join_known(left: DataFrame, right: DataFrame, left_key: Column, right_key: Column) -> DataFrame:
    """All rows of ``left`` with their partners of ``right``, as a left join gives them.

    Rows without a key have no partner, however many they are. They go past the join: shuffled by
    their key, all of them would meet in one task. Works for batches and for streams; ``left`` is read
    once for each of its two parts. ``right_key`` must be no expression that makes a key of a NULL.
    """
    known = left.where(left_key.isNotNull()).join(right, left_key == right_key, "left")
    missing = [F.lit(None).cast(field.dataType).alias(field.name) for field in right.schema.fields]
    return known.union(left.where(left_key.isNull()).select("*", *missing))


def owner_ids(questions: DataFrame) -> DataFrame:
    """The distinct users who asked; they stay a DataFrame, whatever their number."""
    return questions.select(F.col("owner.user_id").alias("user_id")).distinct()


def with_owner(questions: DataFrame, users: DataFrame) -> DataFrame:
    """Questions with the columns of their owner; the user's own key is kept once."""
    users = users.withColumnsRenamed(USER_NAMES)
    return left_join_known(questions, users, F.col("owner.user_id"), F.col("user_id"))


def questions_tagged(
    questions: DataFrame, tag: str, first: int, last: int, least_score: int = 1
) -> DataFrame:
    """Questions with a tag, created between two epoch seconds, best score first."""
    return questions.where(
        F.array_contains("tags", tag)
        & F.col("creation_date").between(first, last)
        & (F.col("score") >= least_score)
    ).orderBy(F.desc("score"), "question_id")


def union_users(old: DataFrame, new: DataFrame, dedupe: bool = True) -> DataFrame:
    """Both user sets, matched by column name.

    A user of both sets, or with several rows in one, would multiply the posts joined to them.
    With ``dedupe`` one row per user is left: from the new set if it is there, and within one set
    the first in the order of all columns. Rows without id are different users and all stay.
    """
    both = old.withColumn("_rank", F.lit(1)).unionByName(new.withColumn("_rank", F.lit(0)))
    if dedupe:
        others = [c for c in old.columns if c != "user_id"]
        first = Window.partitionBy("user_id").orderBy("_rank", *others)
        known = both.where(F.col("user_id").isNotNull())
        known = known.withColumn("_place", F.row_number().over(first)).where(F.col("_place") == 1)
        both = known.drop("_place").unionByName(both.where(F.col("user_id").isNull()))
    return both.drop("_rank")


def series_ids(
    areas: DataFrame,
    area_column: str,
    jobs: Sequence[str],
    industry: str = "000000",
    statistic: str = "03",
) -> DataFrame:
    """A series id for every area and each of a few given jobs.

    The jobs are an argument, so they are exploded from a literal; no join takes place.
    """
    codes = F.explode(F.array(*[F.lit(job) for job in jobs])).alias("job_code")
    return areas.select(F.col(area_column).alias("area_code"), codes).withColumn(
        "series_id",
        F.concat(F.lit("OEUM"), "area_code", F.lit(industry), "job_code", F.lit(statistic)),
    )


def flatten_series(documents: DataFrame, first_period: str = "M01", last_period: str = "M12") -> DataFrame:
    """One row per reading of ``Results.series[].data[]``, its footnote texts joined by commas."""
    readings = documents.select(F.explode("Results.series").alias("series")).select(
        F.col("series.seriesID").alias("series_id"), F.explode("series.data").alias("reading")
    )
    return readings.where(
        F.col("reading.period").between(first_period, last_period)
    ).select(
        "series_id",
        F.col("reading.year").alias("year"),
        F.col("reading.period").alias("period"),
        F.col("reading.value").alias("value"),
        joined_texts("reading.footnotes").alias("footnotes"),
    )
