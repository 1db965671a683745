"""Tables of a database reached through JDBC."""

from __future__ import annotations

import time
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

# Fixed value: the query listing the base tables of the default schema.
LIST_TABLES = (
    "SELECT table_name FROM INFORMATION_SCHEMA.TABLES "
    "WHERE table_schema = 'dbo' AND table_type = 'BASE TABLE'"
)


def split_options(column: str, low: object, high: object, partitions: int) -> dict[str, str]:
    """Reader options that cut a table into ranges of a column, read side by side."""
    if low is None or high is None:
        return {}
    return {
        "partitionColumn": column,
        "lowerBound": str(low),
        "upperBound": str(high),
        "numPartitions": str(partitions),
    }


def read_query(spark: SparkSession, connection: Mapping[str, str], sql: str) -> DataFrame:
    """The result of a query which the database runs."""
    return spark.read.format("jdbc").options(**connection).option("query", sql).load()


def read_table(
    spark: SparkSession,
    connection: Mapping[str, str],
    table: str,
    split_by: str | None = None,
    partitions: int = 1,
    fetch_size: int = 10_000,
) -> DataFrame:
    """A whole table; with ``split_by`` in several ranges of that column.

    The bounds only place the cuts. Rows outside of them, and NULLs, are still read.
    """
    reader = (
        spark.read.format("jdbc")
        .options(**connection)
        .option("dbtable", table)
        .option("fetchsize", fetch_size)
    )
    if split_by is not None and partitions > 1:
        bounds = read_query(
            spark, connection, f"SELECT min({split_by}) AS low, max({split_by}) AS high FROM {table}"
        ).first()
        reader = reader.options(**split_options(split_by, bounds[0], bounds[1], partitions))
    return reader.load()


def list_tables(
    spark: SparkSession,
    connection: Mapping[str, str],
    sql: str = LIST_TABLES,
    wait_seconds: float = 10,
) -> list[str]:
    """Table names from the database's own catalog; asked once more if the first try fails."""

    def ask() -> list[str]:
        return [row[0] for row in read_query(spark, connection, sql).collect()]

    try:
        return ask()
    except Exception:
        time.sleep(wait_seconds)
        return ask()
