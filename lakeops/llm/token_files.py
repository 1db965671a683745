"""Token ids of documents as Parquet list columns (operator 5).

One row per document, in ascending order of its id through all files: ``doc_id`` and ``n_tokens`` as
delta-encoded columns, ``ids`` as a dictionary-encoded list. Row groups and pages are small enough
that the page index lets a reader skip to a few documents, or read lengths without any token.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from lakeops.llm.tokens import default_path, word_tokenizer

SCHEMA = "doc_id long, n_tokens long, ids array<int>"


def write_token_files(
    docs: DataFrame,
    path: str,
    tokenizer: str | None = None,
    end_id: int = 2,
    row_group_bytes: int = 32 << 20,
    page_bytes: int = 256 << 10,
    page_rows: int = 2_000,
) -> None:
    """Encode the texts and write them under ``path``.

    A missing or empty text becomes the end id alone. Documents without id come first; rows which
    share an id follow each other. Only ``doc_id`` and ``text`` are read.
    """
    file = tokenizer or default_path()

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, end = word_tokenizer(file), np.array([end_id], "<u4").tobytes()
        for batch in batches:
            parts = [ids + end for ids in encoder.ids_of(batch.column("text").to_pylist())]
            lengths = np.fromiter((len(p) // 4 for p in parts), np.int64, len(parts))
            offsets = np.concatenate(([0], np.cumsum(lengths))).astype(np.int32)
            values = pa.array(np.frombuffer(b"".join(parts), "<i4"))
            ids = pa.ListArray.from_arrays(pa.array(offsets), values)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(lengths), ids], names=["doc_id", "n_tokens", "ids"]
            )

    # Texts, which are shorter than their ids, are what travels; ids are made where they are written.
    ordered = (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
        .withColumn("__text_hash", F.xxhash64("text"))
        .repartitionByRange("doc_id", "__text_hash")
        .sortWithinPartitions("doc_id", "__text_hash")
        .select("doc_id", "text")
    )
    (
        ordered.mapInArrow(encoded, SCHEMA)
        .write.option("compression", "zstd")
        .option("parquet.writer.version", "v2")
        .option("parquet.enable.dictionary#doc_id", "false")
        .option("parquet.enable.dictionary#n_tokens", "false")
        .option("parquet.block.size", str(row_group_bytes))
        .option("parquet.page.size", str(page_bytes))
        .option("parquet.page.row.count.limit", str(page_rows))
        .parquet(path)
    )


def read_lengths(spark: SparkSession, path: str) -> DataFrame:
    """Ids and lengths of the documents; no page of the token column is read."""
    return spark.read.schema(SCHEMA).parquet(path).select("doc_id", "n_tokens")


def read_tokens(spark: SparkSession, path: str, first_id: int, last_id: int) -> DataFrame:
    """The rows of a range of ids; other row groups and pages are skipped by their statistics."""
    return spark.read.schema(SCHEMA).parquet(path).filter(F.col("doc_id").between(first_id, last_id))


def digests(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id``, ``start``, ``n_tokens``, ``ids_crc32`` of the stored documents, in file order.

    Starts are running sums within each file, plus the sum of all files before it: one row per file.
    """

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("ids")
            values, offsets = ids.values.to_numpy(zero_copy_only=False), ids.offsets.to_numpy()
            crcs = [
                zlib.crc32(np.ascontiguousarray(values[a:b], "<i4")) for a, b in zip(offsets[:-1], offsets[1:])
            ]
            lengths = pa.array(np.diff(offsets).astype(np.int64))
            columns = [batch.column("doc_id"), lengths, pa.array(crcs, pa.int64()), batch.column("file"), batch.column("row")]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_tokens", "ids_crc32", "file", "row"])

    stored = (
        spark.read.schema(SCHEMA)
        .parquet(path)
        .select(
            "doc_id",
            "ids",
            F.regexp_extract("_metadata.file_name", r"part-(\d+)", 1).cast("long").alias("file"),
            F.col("_metadata.row_index").alias("row"),
        )
        .mapInArrow(summed, "doc_id long, n_tokens long, ids_crc32 long, file long, row long")
    )
    in_file = Window.partitionBy("file").orderBy("row").rowsBetween(Window.unboundedPreceding, -1)
    before = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    lengths = spark.read.schema(SCHEMA).parquet(path).select(
        F.regexp_extract("_metadata.file_name", r"part-(\d+)", 1).cast("long").alias("file"), "n_tokens"
    )
    files = (
        lengths.groupBy("file")
        .agg(F.sum("n_tokens").alias("__total"))
        .select("file", F.coalesce(F.sum("__total").over(before), F.lit(0)).alias("__before"))
    )
    return (
        stored.withColumn("__in_file", F.coalesce(F.sum("n_tokens").over(in_file), F.lit(0)))
        .join(files, "file")
        .select("doc_id", (F.col("__before") + F.col("__in_file")).alias("start"), "n_tokens", "ids_crc32")
    )
