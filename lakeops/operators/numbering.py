"""Consecutive numbers over a whole table, without a single-task sort."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from lakeops.functions.time import literal
from lakeops.session import written

# monotonically_increasing_id() puts the partition above bit 33 and the row's place below it.
_PLACE_BITS = 33


def with_row_number(
    df: DataFrame, order: Sequence[str], name: str = "row_number", start: int = 1
) -> DataFrame:
    """Number rows from ``start`` in the given order, without gaps.

    The rows are range partitioned, sorted within partitions and written once together with their
    places, so that every later step (and a retry after a lost executor) sees the same places. Only
    the row count of each partition comes to the driver. The order has to be unique for a
    repeatable result.
    """
    return _numbered(df, order, name, start)[0]


def _numbered(df: DataFrame, order: Sequence[str], name: str, start: int) -> tuple[DataFrame, int]:
    """The numbered rows, and the number behind the last one."""
    columns = df.columns
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order)
    placed = written(ranged.withColumn("_place", F.monotonically_increasing_id()), "numbered")
    part = F.shiftright("_place", _PLACE_BITS).cast("int")
    sizes = placed.groupBy(part.alias("part")).count().collect()
    counts = {row["part"]: row["count"] for row in sizes}
    starts, total = [], start
    for number in range(max(counts, default=0) + 1):
        starts.append(total)
        total += counts.get(number, 0)
    # One number per partition, as a constant: small whatever the table's size.
    first = F.split(F.lit(",".join(map(str, starts))), ",").cast("array<bigint>")
    within = F.col("_place").bitwiseAND(F.lit((1 << _PLACE_BITS) - 1))
    return placed.select(*columns, (F.get(first, part) + within).alias(name)), total


def assign_ids(
    new_rows: DataFrame, id_column: str, order: Sequence[str], highest: int = 0
) -> DataFrame:
    """Give new rows the numbers after the highest one in use."""
    return assign_ids_upto(new_rows, id_column, order, highest)[0]


def assign_ids_upto(
    new_rows: DataFrame, id_column: str, order: Sequence[str], highest: int = 0
) -> tuple[DataFrame, int]:
    """The same, and the highest number in use then, which needs no look at the rows."""
    numbered, behind = _numbered(new_rows.drop(id_column), order, id_column, highest + 1)
    return numbered.select(id_column, *[c for c in new_rows.columns if c != id_column]), behind - 1


def highest_id(table: DataFrame, id_column: str) -> int:
    return table.agg(F.coalesce(F.max(id_column), F.lit(0)).alias("high")).first()["high"]


def with_page(
    df: DataFrame, order: Sequence[str], page_size: int, name: str = "page"
) -> DataFrame:
    """Cut the ordered rows into pages, the first being 0; all pages in one job."""
    numbered = with_row_number(df, order, "_number", 0)
    page = F.floor(F.col("_number") / page_size).cast("long")
    return numbered.withColumn(name, page).drop("_number")


def next_page(
    df: DataFrame, order: Sequence[str], page_size: int, after: Sequence | None = None
) -> DataFrame:
    """The page behind the cursor ``after``, which holds the order columns of the last row seen.

    Sort and limit become one top-k, so each task passes on at most ``page_size`` rows.
    """
    if after is not None:
        # (a, b) > (x, y) as: a >= x AND (a > x OR b > y); the first part reaches the scan.
        beyond = F.lit(False)
        last = [literal(value, df.schema[name].dataType) for name, value in zip(order, after)]
        for name, value in reversed(list(zip(order, last))):
            beyond = (F.col(name) > value) | ((F.col(name) == value) & beyond)
        df = df.where((F.col(order[0]) >= last[0]) & beyond)
    return df.orderBy(*order).limit(page_size)


def page_cursor(page: DataFrame, order: Sequence[str]) -> tuple | None:
    """Order columns of the page's last row, or None for an empty page."""
    last = page.agg(F.max(F.struct(*order)).alias("last")).first()["last"]
    return tuple(last) if last is not None else None
