"""Expressions between rows and JSON text."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import StructType


def expand_json(df: DataFrame, column: str, schema: StructType | str) -> DataFrame:
    """One column per schema field; text that is not JSON gives NULL in all of them."""
    parsed = F.from_json(F.col(column).cast("string"), schema)
    return df.select(parsed.alias("json")).select("json.*")


def key_value_messages(df: DataFrame, key: str) -> DataFrame:
    """Each row as a message: the key as text, the whole row as JSON."""
    return df.select(
        F.col(key).cast("string").alias("key"),
        F.to_json(F.struct(*df.columns)).alias("value"),
    )
