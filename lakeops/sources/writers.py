"""Sinks for batches."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, functions as F


# Tasks read or receive some 64 MB each. With so few folders their files are still megabytes.
FEW_FOLDERS = 16
# Strings of the second Parquet version are stored by what differs from the one before.
STORED = {"compression": "zstd", "parquet.writer.version": "PARQUET_2_0"}


def spread(df: DataFrame, partition_by: Sequence[str] = ()) -> DataFrame:
    """Bring rows of one output folder together before a partitioned write.

    Without this each task writes a file into each folder. The rebalance hint lets adaptive
    execution split a folder that holds far more rows than the others. A folder name cannot tell an
    empty string from NULL, so an empty string in a partition column fails the job.
    """
    return told_apart(df, partition_by).hint("rebalance", *partition_by) if partition_by else df


def told_apart(df: DataFrame, partition_by: Sequence[str]) -> DataFrame:
    """The same rows; the job fails when a partition column holds an empty string."""
    kinds = dict(df.dtypes)
    for column in partition_by:
        if kinds[column] == "string":
            error = F.raise_error(F.lit(f"empty string in partition column {column}")).cast("boolean")
            df = df.where(F.when(F.col(column) == "", error).otherwise(F.lit(True)))
    return df


def few_folders(df: DataFrame, partition_by: Sequence[str]) -> bool:
    """Whether a stored table makes so few folders that each task may write into all of them."""
    return df.select(*partition_by).distinct().limit(FEW_FOLDERS + 1).count() <= FEW_FOLDERS


def overwrite(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    writer = spread(df, partition_by).write.mode("overwrite").options(**STORED)
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def overwrite_counted(
    df: DataFrame, path: str, partition_by: Sequence[str], gathered: bool = False, **counts: Column
) -> dict[str, int]:
    """Overwrite a path, and return aggregates over the rows, taken while they are written.

    ``gathered`` rows lie in tasks as they shall be written: they are not shuffled by folder.
    They are observed behind the last shuffle, in the tasks which write: of those Spark counts each
    partition once, even if a task is repeated.
    """
    seen = Observation()
    dealt = told_apart(df, partition_by) if gathered else spread(df, partition_by)
    observed = dealt.observe(seen, *[c.alias(name) for name, c in counts.items()])
    writer = observed.write.mode("overwrite").options(**STORED)
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)
    return seen.get


def overwrite_table(
    df: DataFrame, name: str, partition_by: Sequence[str] = (), path: str | None = None
) -> None:
    """Replace a named catalog table."""
    writer = spread(df, partition_by).write.format("parquet").mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if path is not None:
        writer = writer.option("path", path)
    writer.saveAsTable(name)


def append_evolving(df: DataFrame, path: str) -> None:
    """Append rows which may bring new columns; read them back with ``read_evolved``.

    Appending the same rows twice keeps them twice.
    """
    df.write.mode("append").parquet(path)


def send_messages(messages: DataFrame, options: Mapping[str, str], format: str = "kafka") -> None:
    """Hand key/value messages to a broker, or to any other batch sink."""
    messages.write.format(format).options(**options).mode("append").save()
