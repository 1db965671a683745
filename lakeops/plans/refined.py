"""Raw to refined: bring keyed tables in line with their raw extracts."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession

from lakeops.plans.jobs import run_tables
from lakeops.sources.files import read_table
from lakeops.sources.writers import few_folders
from lakeops.tables.versioned import VersionedTable


@dataclass(frozen=True)
class RefinedTable:
    """What to load: key columns, and columns or expressions such as ``_Id AS id``."""

    name: str
    keys: Sequence[str]
    columns: Sequence[str]
    partition_by: Sequence[str] = ()

    def selected(self) -> list[str]:
        """The columns, with key columns added which the list lacks."""
        named = {c.lower().split(" as ")[-1].strip() for c in self.columns}
        return [k for k in self.keys if k.lower() not in named] + list(self.columns)


def load_refined(
    spark: SparkSession,
    config: RefinedTable,
    raw_root: str,
    refined_root: str,
    raw_format: str = "parquet",
    committed_at: datetime | None = None,
    null_safe: bool = True,
) -> int | None:
    """Load one table; returns the new version, or None if nothing changed."""
    source = read_table(spark, f"{raw_root}/{config.name}", config.selected(), raw_format)
    table = VersionedTable(spark, f"{refined_root}/{config.name}")
    # The extract is stored, so its folders can be counted ahead of the first load.
    few = not table.exists() and (not config.partition_by or few_folders(source, config.partition_by))
    return table.sync(
        source,
        list(config.keys),
        committed_at=committed_at,
        partition_by=config.partition_by,
        gathered=few,
        null_safe=null_safe,
    )


def load_all_refined(
    spark: SparkSession,
    configs: Sequence[RefinedTable],
    raw_root: str,
    refined_root: str,
    workers: int = 4,
    seconds: float | None = None,
    **options,
) -> DataFrame:
    """Load several tables side by side, each within ``seconds`` if given; one status row per table."""
    by_name = {config.name: config for config in configs}
    return run_tables(
        spark,
        by_name,
        lambda name: load_refined(spark, by_name[name], raw_root, refined_root, **options),
        workers,
        seconds,
    )
