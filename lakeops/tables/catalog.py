"""Databases, typed tables and views of the session catalog."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from lakeops.tables.versioned import VersionedTable

# Columns of the curated price tables.
CURATED_TABLES = {
    "dim_area": (
        "dim_area_id bigint, area_code string, area_name string, display_level bigint, "
        "is_deleted boolean, last_modified timestamp"
    ),
    "dim_series": (
        "dim_series_id bigint, series_id string, area_code string, item_code string, "
        "seasonal string, periodicity_code string, base_code string, base_period string, "
        "series_title string, begin_year bigint, begin_period string, end_year bigint, "
        "end_period string, is_deleted boolean, last_modified timestamp"
    ),
    "dim_item": (
        "dim_item_id bigint, item_code string, item_name string, display_level bigint, "
        "sort_sequence bigint, is_deleted boolean, last_modified timestamp"
    ),
    "fact_current": (
        "dim_series_id bigint, dim_area_id bigint, dim_item_id bigint, year bigint, "
        "period string, value double, is_deleted boolean, last_modified timestamp"
    ),
}


def create_database(
    spark: SparkSession, name: str, location: str, replace: bool = False
) -> None:
    """A database whose tables lie below a location.

    An existing one stays as it is, unless ``replace`` asks to drop it first, tables included.
    """
    if replace and spark.catalog.databaseExists(name):
        spark.sql(f"DROP DATABASE {name} CASCADE")
    place = location.replace("'", "\\'")
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name} LOCATION '{place}'")


def create_table(
    spark: SparkSession, name: str, columns: str | StructType, partition_by: Sequence[str] = ()
) -> None:
    """An empty typed Parquet table."""
    ddl = columns if isinstance(columns, str) else columns.toDDL()
    parts = f" PARTITIONED BY ({', '.join(partition_by)})" if partition_by else ""
    spark.sql(f"CREATE TABLE {name} ({ddl}) USING parquet{parts}")


def drop_table(spark: SparkSession, name: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def create_statement(spark: SparkSession, name: str) -> str:
    return spark.sql(f"SHOW CREATE TABLE {name}").first()[0]


def refresh(spark: SparkSession, path: str) -> None:
    """Forget cached files and rows of a path which was written anew."""
    spark.catalog.refreshByPath(path)


def view(table: VersionedTable, name: str, version: int | None = None) -> DataFrame:
    """Make a versioned table known to SQL, as of now."""
    rows = table.read(version)
    rows.createOrReplaceTempView(name)
    return rows
