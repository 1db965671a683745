"""Profiles of raw tables: value ranges, gaps, distinct counts, keys and sizes."""

from __future__ import annotations

import itertools
import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import (
    BooleanType,
    DoubleType,
    FloatType,
    NumericType,
    StringType,
    DateType,
    TimestampNTZType,
    TimestampType,
)

from lakeops.sources.files import table_folders

_TEXT_LIKE = (StringType, BooleanType, DateType, TimestampType, TimestampNTZType)


# Relative standard deviation of the sketches of a key search, and how many a scan takes along.
SKETCH_ERROR = 0.02
SKETCHES_AT_ONCE = 100
# Size of the distinct sketches of a growing profile (logarithm), and four of their standard deviations.
SKETCH_BITS = 14
DISTINCT_BOUND = 4 * 1.04 / 2 ** (SKETCH_BITS / 2)
# Longer texts travel as their digest, which has one letter more than this.
_SHORT = 32


def _distinct_text(field) -> Column:
    """A text which is equal exactly for equal values; adding 0.0 makes -0.0 equal to 0.0."""
    value = F.col(f"`{field.name}`")
    if isinstance(field.dataType, (FloatType, DoubleType)):
        value = value + F.lit(0.0).cast(field.dataType)
    if isinstance(field.dataType, (NumericType, *_TEXT_LIKE)):
        text = value.cast("string")
    else:
        text = F.when(value.isNotNull(), F.to_json(F.struct(value)))
    return F.when(F.length(text) > _SHORT, F.concat(F.lit("#"), F.md5(text))).otherwise(text)


def profile_columns(df: DataFrame, distinct: str = "exact") -> DataFrame:
    """One row per column: rows, NULLs, NaNs, distinct values, smallest and largest value.

    Numbers report their range in ``min_number``/``max_number`` (NaN left out), all but fractions also
    in ``min_text``/``max_text``, exactly. Texts, flags and times report theirs there. Binary and nested
    columns have counts only. The ranges need one aggregation without a shuffle of rows. The exact
    distinct counts need a second scan: (column, value) pairs are made distinct within each task
    and then by hash of the pair, so a frequent value costs no more than a rare one.
    ``distinct="approx"`` estimates them in the first pass instead.
    """
    fields = df.schema.fields

    def described(field) -> Column:
        value = F.col(f"`{field.name}`")
        number = isinstance(field.dataType, NumericType)
        fraction = isinstance(field.dataType, (FloatType, DoubleType))
        exact = isinstance(field.dataType, (NumericType, *_TEXT_LIKE)) and not fraction
        ranged = F.when(~F.isnan(value), value) if fraction else value
        none_number, none_text = F.lit(None).cast("double"), F.lit(None).cast("string")
        low, high = (F.min(ranged), F.max(ranged)) if number or exact else (none_text, none_text)
        return F.struct(
            F.lit(field.name).alias("column_name"),
            F.count(F.lit(1)).alias("row_count"),
            F.count_if(value.isNull()).alias("null_count"),
            (F.count_if(F.isnan(value)) if fraction else F.lit(0).cast("long")).alias("nan_count"),
            (low.cast("double") if number else none_number).alias("min_number"),
            (high.cast("double") if number else none_number).alias("max_number"),
            (low.cast("string") if exact else none_text).alias("min_text"),
            (high.cast("string") if exact else none_text).alias("max_text"),
            (
                F.approx_count_distinct(_distinct_text(field))
                if distinct == "approx"
                else F.lit(None).cast("long")
            ).alias("distinct_count"),
        )

    ranges = df.agg(F.array(*map(described, fields)).alias("all")).select(F.inline("all"))
    if distinct == "approx":
        return ranges
    pairs = df.select(
        F.inline(
            F.array(
                *[
                    F.struct(F.lit(f.name).alias("column_name"), _distinct_text(f).alias("value"))
                    for f in fields
                ]
            )
        )
    )
    counts = (
        pairs.where(F.col("value").isNotNull())
        .distinct()
        .groupBy("column_name")
        .agg(F.count(F.lit(1)).alias("found"))
    )
    # One row per column on either side.
    return (
        ranges.join(counts, "column_name", "left")
        .withColumn("distinct_count", F.coalesce("found", F.lit(0)))
        .drop("found")
    )


def key_check(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row: could these columns be the business key?

    Counting per key is combined within tasks first, so a key of many copies does no harm.
    """
    missing = F.lit(False)
    for key in keys:
        missing = missing | F.col(key).isNull()
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies"))
    total = per_key.agg(
        F.coalesce(F.sum("copies"), F.lit(0)).alias("row_count"),
        F.count(F.lit(1)).alias("key_count"),
        F.count_if(F.col("copies") > 1).alias("repeated_keys"),
        F.coalesce(F.sum(F.when(missing, F.col("copies"))), F.lit(0)).alias("null_key_rows"),
    )
    return total.withColumn(
        "is_key", (F.col("repeated_keys") == 0) & (F.col("null_key_rows") == 0)
    )


def _surely_repeated(estimate: float, rows: int) -> bool:
    """Whether an estimate of distinct values is too low for them to be as many as the rows.

    Six standard deviations of the sketch; what is nearer is counted.
    """
    return estimate < rows * (1 - 6 * SKETCH_ERROR)


def key_candidates(
    df: DataFrame, columns: Sequence[str] | None = None, most_columns: int = 3
) -> DataFrame:
    """One row per minimal business key: sets of columns without NULL whose values never repeat.

    Sets are searched level by level, from single columns up to ``most_columns``. A set that holds a
    key is none that is minimal. One that has fewer combinations than rows, by the product of its
    columns' distinct values or by a sketch of all sets of the level (one scan), is left out; all others
    are counted exactly, one shuffle of their own columns each. Columns: ``key_columns`` (names joined
    by commas, in the order of the table), ``column_count``. A table without rows has no key.
    """
    spark = df.sparkSession
    names = list(df.columns if columns is None else columns)
    found: list[tuple[str, ...]] = []
    first = df.agg(
        F.count(F.lit(1)).alias("rows"),
        *(F.count_if(F.col(f"`{c}`").isNull()).alias(f"nulls_{i}") for i, c in enumerate(names)),
        *(F.approx_count_distinct(F.col(f"`{c}`"), SKETCH_ERROR).alias(f"seen_{i}") for i, c in enumerate(names)),
    ).first()
    rows = first["rows"]
    seen = {c: first[f"seen_{i}"] for i, c in enumerate(names) if rows and not first[f"nulls_{i}"]}
    level = [(c,) for c in seen]
    estimates = {(c,): n for c, n in seen.items()}
    for size in range(1, most_columns + 1):
        if size > 1:
            level = [s for s in level if math.prod(seen[c] * (1 + 6 * SKETCH_ERROR) for c in s) >= rows]
            estimates = _estimated(df, level)
        unique = [s for s in level if not _surely_repeated(estimates[s], rows) and _is_unique(df, s)]
        found += unique
        # Wider sets of columns that are no key yet; none of their parts may be one.
        base = [s for s in itertools.combinations(seen, size + 1)]
        level = [s for s in base if not any(set(k) <= set(s) for k in found)]
    schema = "key_columns string, column_count int"
    return spark.createDataFrame([(",".join(k), len(k)) for k in found], schema)


def _estimated(df: DataFrame, sets: Sequence[tuple[str, ...]]) -> dict[tuple[str, ...], int]:
    """Sketched numbers of combinations, ``SKETCHES_AT_ONCE`` sets a scan."""
    result = {}
    for at in range(0, len(sets), SKETCHES_AT_ONCE):
        some = sets[at : at + SKETCHES_AT_ONCE]
        values = df.agg(
            *(
                F.approx_count_distinct(F.xxhash64(*(F.col(f"`{c}`") for c in s)), SKETCH_ERROR).alias(str(i))
                for i, s in enumerate(some)
            )
        ).first()
        result.update(zip(some, values))
    return result


def _is_unique(df: DataFrame, columns: tuple[str, ...]) -> bool:
    copies = df.groupBy(*(F.col(f"`{c}`") for c in columns)).agg(F.count(F.lit(1)).alias("_copies"))
    return copies.where("_copies > 1").isEmpty()


class GrowingProfile:
    """The profile of a table that only grows, kept as sketches of its commits.

    Each commit's rows are scanned once, when they come, and leave one row per column in a folder of
    their own: counts, range, a sketch of the distinct values (HyperLogLog) and, for numbers, one of
    the quantiles (KLL). The profile merges these rows and reads nothing of the table. A commit that is
    added again replaces its own rows. Deleted rows cannot be taken out of sketches: profile a table
    whose rows are also deleted with ``profile_columns``.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def add(self, rows: DataFrame, commit: int) -> None:
        """Take in the new rows of a commit."""
        fields = rows.schema.fields
        kept = rows.agg(F.array(*map(self._sketched, fields)).alias("all")).select(F.inline("all"))
        kept.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/commit={commit}")

    @staticmethod
    def _sketched(field) -> Column:
        value = F.col(f"`{field.name}`")
        number = isinstance(field.dataType, NumericType)
        fraction = isinstance(field.dataType, (FloatType, DoubleType))
        as_number = value.cast("double") if number else F.lit(None).cast("double")
        ranged = F.when(~F.isnan(as_number), as_number)
        return F.struct(
            F.lit(field.name).alias("column_name"),
            F.count(F.lit(1)).alias("row_count"),
            F.count_if(value.isNull()).alias("null_count"),
            (F.count_if(F.isnan(value)) if fraction else F.lit(0).cast("long")).alias("nan_count"),
            F.min(ranged).alias("min_number"),
            F.max(ranged).alias("max_number"),
            F.hll_sketch_agg(_distinct_text(field), SKETCH_BITS).alias("values"),
            (F.kll_sketch_agg_double(ranged) if number else F.lit(None).cast("binary")).alias("quantiles"),
        )

    def commits(self) -> list[int]:
        """The commits that were taken in."""
        return sorted(int(name.partition("=")[2]) for _, name in table_folders(self.spark, self.path))

    def profile(self, quantiles: Sequence[float] = (0.5,)) -> DataFrame:
        """One row per column: exact counts and ranges, estimated distinct values and quantiles.

        ``distinct_count`` is off by ``DISTINCT_BOUND`` of the true number at most, but for about one
        column in ten thousand; a quantile by about one per cent of the rows in rank.
        """
        stored = self.spark.read.parquet(self.path)
        merged = stored.groupBy("column_name").agg(
            *(F.sum(c).alias(c) for c in ("row_count", "null_count", "nan_count")),
            F.min("min_number").alias("min_number"),
            F.max("max_number").alias("max_number"),
            F.hll_sketch_estimate(F.hll_union_agg("values", F.lit(True))).alias("distinct_count"),
            F.kll_merge_agg_double("quantiles").alias("_quantiles"),
        )
        # Without a number there is no quantile.
        ranks = F.array(*map(F.lit, quantiles))
        found = F.when(
            F.col("min_number").isNotNull(), F.kll_sketch_get_quantile_double("_quantiles", ranks)
        )
        return merged.withColumn("quantiles", found).drop("_quantiles")


def table_sizes(spark: SparkSession, root: str) -> DataFrame:
    """Files and bytes below each entry of a root folder, from the file listing alone."""
    root = root.rstrip("/")
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .load(root)
        .select("path", "length")
    )
    # The part of the path after the root's own name.
    below = F.substring_index("path", f"{root}/", -1)
    return (
        files.groupBy(F.substring_index(below, "/", 1).alias("table_name"))
        .agg(
            F.count(F.lit(1)).alias("file_count"),
            F.sum("length").alias("size_bytes"),
        )
    )
