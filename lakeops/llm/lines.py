"""Removal of repeated lines by keep bitmaps, in DataFrame functions only (operator 4)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from lakeops.llm.common import BLANKS, LOWER, UPPER
from lakeops.session import written

BITS = 64


def line_key(line: Column) -> Column:
    """Without blanks at the ends and with A to Z lowered."""
    return F.translate(F.btrim(line, F.lit(BLANKS)), UPPER, LOWER)


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def _row_key() -> list[Column]:
    """Names a row of documents: rows that agree in id and text are treated alike."""
    return [F.col("doc_id").alias("__doc"), F.xxhash64("text").alias("__row")]


def drop_bitmaps(docs: DataFrame, least_length: int = 20, least_docs: int = 3) -> DataFrame:
    """The bitmap of dropped lines of each row that loses any: ``__doc``, ``__row``, ``words``.

    ``words`` lists the 64-bit words with set bits as (word, bits): bit i of word w stands for line
    64 w + i, and all other lines are kept. A key of at least ``least_length`` code points that is
    found in ``least_docs`` documents or more keeps its lines in the largest document only.

    Occurrences are range-partitioned by the hash of their key and sorted by document and position,
    so that the first of each document is seen in one pass and a hot key spreads over partitions.
    Counts of documents are combined before they travel. The join back reads both sides from stored
    tables, so that adaptive execution splits the partition of a hot key.
    """
    positions = F.transform(
        _lines(F.col("text")),
        lambda line, i: F.struct(i.cast("long").alias("position"), line_key(line).alias("key")),
    )
    long_enough = F.filter(positions, lambda p: F.char_length(p["key"]) >= least_length)
    occurrences = written(
        docs.select(*_row_key(), F.explode(long_enough).alias("__line"))
        .select("__doc", "__row", "__line.position", F.unhex(F.md5("__line.key")).alias("key"))
        .repartitionByRange("key", "__doc")
        .sortWithinPartitions("key", "__doc", "__row", "position"),
        "lines",
    )
    # A document's occurrences of a key lie in one file, so each task hands on the first of them only.
    first = occurrences.groupBy("key", "__doc").agg(F.lit(1).alias("one"))
    keys = written(
        first.groupBy("key")
        .agg(F.count("one").alias("docs"), F.max("__doc").alias("last"))
        .filter(F.col("docs") >= least_docs)
        .select("key", "last"),
        "line-keys",
    )
    dropped = occurrences.join(keys, "key").filter(F.col("__doc").isNull() | (F.col("__doc") < F.col("last")))
    return (
        dropped.groupBy("__doc", "__row", F.expr(f"position div {BITS}").alias("word"))
        .agg(F.bit_or(F.expr(f"shiftleft(1L, cast(position % {BITS} as int))")).alias("bits"))
        .groupBy("__doc", "__row")
        .agg(F.array_sort(F.collect_list(F.struct("word", "bits"))).alias("words"))
    )


def _dense(words: Column) -> Column:
    """One number for each word of lines, with the words that are left out as zeros."""
    return F.flatten(
        F.transform(
            words,
            lambda w, i: F.concat(
                F.array_repeat(
                    F.lit(0).cast("long"),
                    (w["word"] - F.when(i > 0, F.get(words, i - 1)["word"]).otherwise(-1) - 1).cast("int"),
                ),
                F.array(w["bits"]),
            ),
        )
    )


def deduplicate_lines(docs: DataFrame, least_length: int = 20, least_docs: int = 3) -> DataFrame:
    """All columns of ``docs`` with the shortened text, and ``__n_lines`` and ``__n_dropped``.

    A missing or empty text is one empty line and stays as it is (a missing one stays missing). Rows
    with the same id count as one document; rows without id count as one document that comes before
    all others. An empty table stays empty.
    """
    bitmaps = drop_bitmaps(docs, least_length, least_docs)
    keyed = docs.withColumn("__row", F.xxhash64("text"))
    joined = keyed.join(
        bitmaps.withColumnRenamed("__row", "__bitmap_row"),
        F.col("doc_id").eqNullSafe(F.col("__doc")) & (F.col("__row") == F.col("__bitmap_row")),
        "left",
    ).withColumn("__dense", _dense(F.col("words")))
    kept = F.filter(
        _lines(F.col("text")),
        lambda line, i: F.coalesce(
            F.expr("1") * F.getbit(F.get(F.col("__dense"), F.floor(i / BITS).cast("int")), i % BITS), F.lit(0)
        )
        == 0,
    )
    counts = F.aggregate("words", F.lit(0).cast("long"), lambda n, w: n + F.bit_count(w["bits"]))
    result = joined.select(
        *[F.col(c) for c in docs.columns if c != "text"],
        F.when(F.col("words").isNull(), F.col("text")).otherwise(F.array_join(kept, "\n")).alias("text"),
        F.size(_lines(F.col("text"))).cast("long").alias("__n_lines"),
        F.coalesce(counts, F.lit(0)).alias("__n_dropped"),
    )
    return result.select(*docs.columns, "__n_lines", "__n_dropped")
