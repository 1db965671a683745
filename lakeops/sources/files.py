"""Files: Parquet, JSON and text; XML is read by its own module."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from lakeops.sources.xml import read_xml  # noqa: F401


def read_table(
    spark: SparkSession, path: str, columns: Sequence[str] | None = None, format: str = "parquet"
) -> DataFrame:
    """A stored table; ``columns`` may be names or expressions such as ``_Id AS id``."""
    table = spark.read.format(format).load(path)
    return table.selectExpr(*columns) if columns else table


def read_month(
    spark: SparkSession, root: str, month: str, column: str = "CreationMonth"
) -> DataFrame:
    """One month of a partitioned table.

    The root is read and the partition filtered, which keeps the partition column and still opens
    the files of that month only.
    """
    table = spark.read.parquet(root)
    return table.where(F.col(column) == F.lit(month).cast(table.schema[column].dataType))


def sql_on_path(
    spark: SparkSession, path: str, tail: str = "", columns: str = "*", format: str = "parquet"
) -> DataFrame:
    """A SELECT straight on a path; ``tail`` holds whatever follows FROM."""
    return spark.sql(f"SELECT {columns} FROM {format}.`{path}` {tail}")


def read_evolved(spark: SparkSession, path: str) -> DataFrame:
    """A table to which later appends brought more columns."""
    return spark.read.option("mergeSchema", "true").parquet(path)


# Fixed value: the response fields which the API documents beside the items.
PAGE_FIELDS = "has_more boolean, quota_max bigint, quota_remaining bigint"


def read_pages(
    spark: SparkSession,
    path: str,
    item_schema: StructType | str,
    fields: str | None = PAGE_FIELDS,
    multi_line: bool = False,
) -> DataFrame:
    """Landed API responses: ``items`` plus the response fields, by default the documented ones.

    ``fields=None`` takes all fields that any response has. A response that is cut off, or whose
    values do not fit, fails the job; one that spans lines needs ``multi_line``.
    """
    item = item_schema if isinstance(item_schema, str) else item_schema.simpleString()
    if not item.startswith("struct<"):
        item = f"struct<{item}>"
    reader = spark.read.option("mode", "FAILFAST").option("multiLine", multi_line)
    if fields is None:
        found = reader.json(path).drop("items").schema
        fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in found)
    return reader.schema(", ".join(filter(None, [f"items array<{item}>", fields]))).json(path)


def read_variant_pages(spark: SparkSession, path: str) -> DataFrame:
    """Landed API responses of unknown shape, one per line: ``response`` holds each as a VARIANT.

    The files are read once: no schema is needed to read them, whatever fields the responses have and
    however these differ. A line that is no JSON fails the job; blank lines are skipped.
    """
    lines = spark.read.text(path).where(F.trim("value") != "")
    return lines.select(F.parse_json("value").alias("response"))


def variant_items(pages: DataFrame, field: str = "items") -> DataFrame:
    """One row per item of all responses, as a VARIANT; a response without that list has none."""
    items = F.try_variant_get("response", f"$.{field}", "array<variant>")
    return pages.select(F.explode(items).alias("item"))


def variant_schema(rows: DataFrame, column: str) -> str:
    """The widest shape of a VARIANT column, united within tasks and then over them."""
    return rows.agg(F.schema_of_variant_agg(column)).first()[0].replace("OBJECT<", "STRUCT<")


def variant_fields(rows: DataFrame, column: str, fields: Mapping[str, str]) -> DataFrame:
    """Columns from paths in a VARIANT, such as ``{"owner.user_id": "bigint"}``.

    A column is named after the last part of its path. A value that is missing, or cannot be cast to
    the type, is NULL.
    """
    return rows.select(
        *(
            F.try_variant_get(column, f"$.{path}", kind).alias(path.rsplit(".", 1)[-1])
            for path, kind in fields.items()
        )
    )


def page_items(pages: DataFrame) -> DataFrame:
    """One row per item of all responses."""
    return pages.select(F.inline("items"))


def page_metadata(pages: DataFrame) -> DataFrame:
    """The response fields; the items are not even parsed."""
    return pages.drop("items")


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path)


def _file_system(spark: SparkSession, path: str) -> tuple:
    """The file system of a path, and the path, as Hadoop objects."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), folder


def path_exists(spark: SparkSession, path: str) -> bool:
    files, folder = _file_system(spark, path)
    return files.exists(folder)


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder that the caller has made, with all in it."""
    files, folder = _file_system(spark, path)
    files.delete(folder, True)


def matching_folders(spark: SparkSession, pattern: str) -> list[str]:
    """Folders whose path fits a pattern."""
    files, folder = _file_system(spark, pattern)
    return [entry.getPath().toString() for entry in files.globStatus(folder) or [] if entry.isDirectory()]


def folder_times(spark: SparkSession, root: str) -> dict[str, int]:
    """The folders below a root, each with the time at which it was last written to."""
    files, folder = _file_system(spark, root)
    if not files.exists(folder):
        return {}
    entries = [entry for entry in files.listStatus(folder) if entry.isDirectory()]
    return {entry.getPath().getName(): entry.getModificationTime() for entry in entries}


def table_folders(spark: SparkSession, root: str) -> list[tuple[str, str]]:
    """(path, name) of each folder below the root; a folder holds one table."""
    files, folder = _file_system(spark, root)
    found = [entry.getPath() for entry in files.listStatus(folder) if entry.isDirectory()]
    return sorted((path.toString(), path.getName()) for path in found)
