"""Expressions over timestamps."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import DataType, TimestampNTZType

# Fixed value: where a table that holds no row yet starts to read its feed.
FIRST_LOAD = datetime(2022, 1, 1)


def literal(value: object, kind: DataType) -> Column:
    """A constant of a column's type. A time without zone must not pass through the session's zone."""
    if isinstance(kind, TimestampNTZType):
        value = None if value is None else str(value)
    return F.lit(value).cast(kind)


def month_start(ts: str | Column) -> Column:
    """First day of the month as text."""
    return F.date_format(ts, "yyyy-MM-01")


def epoch_to_timestamp(seconds: str | Column) -> Column:
    return F.timestamp_seconds(seconds)


def epoch_between(df: DataFrame, column: str, first: int, last: int) -> Column:
    """Is the time within two epoch seconds, both included?

    The bounds become literals of the column's own kind, so the comparison reaches the Parquet scan
    as pushed filters. A timestamp without zone is taken as UTC.
    """
    kind = df.schema[column].dataType.typeName()

    def bound(seconds: int) -> Column:
        if kind == "timestamp_ntz":
            text = datetime.fromtimestamp(seconds, timezone.utc).strftime("%Y-%m-%d %H:%M:%S")
            return F.expr(f"TIMESTAMP_NTZ'{text}'")
        return F.timestamp_seconds(F.lit(seconds)) if kind == "timestamp" else F.lit(seconds)

    return F.col(column).between(bound(first), bound(last))


def after_watermark(
    table: DataFrame, column: str, default: datetime = FIRST_LOAD, seconds: int = 1
) -> DataFrame:
    """One row: the time from which the next load has to read.

    The latest value of ``column``, or ``default`` for an empty table, plus ``seconds``.
    """
    latest = F.coalesce(F.max(column), literal(default, table.schema[column].dataType))
    return table.agg((latest + F.expr(f"INTERVAL {seconds} SECOND")).alias(column))
