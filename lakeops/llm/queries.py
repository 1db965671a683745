"""One query for each operator of this package, over its whole table, and SQL where it can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from lakeops.llm import (
    ann,
    decontam,
    hmm,
    lines,
    negatives,
    ngram_join,
    packing,
    pages,
    paragraphs,
    periodic,
    quality,
    token_files,
    transducer,
)
from lakeops.session import scratch_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def register(function):
        QUERIES[function.__name__] = function
        if sql is not None:
            SQL[function.__name__] = sql
        return function

    return register


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/documents.parquet")


BLANK_CHARS = "chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
LINES_SQL = f"""
WITH split AS (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
                      generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS position
               FROM {{source}}),
keyed AS (SELECT *, translate(trim(line, {BLANK_CHARS}), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                              'abcdefghijklmnopqrstuvwxyz') AS key FROM split),
often AS (SELECT key, max(doc_id) AS last FROM keyed WHERE length(key) >= 20
          GROUP BY key HAVING count(DISTINCT doc_id) >= 3),
marked AS (SELECT k.*, o.key IS NOT NULL AND k.doc_id < o.last AS dropped
           FROM keyed k LEFT JOIN often o ON k.key = o.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (dropped) AS n_dropped,
       coalesce(string_agg(line, chr(10) ORDER BY position) FILTER (NOT dropped), '') AS kept
FROM marked GROUP BY doc_id"""


@query(
    f"SELECT doc_id, n_lines, n_dropped, sha256(kept) AS kept_sha256 FROM ({LINES_SQL.format(source='documents')})"
)
def op4_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    shortened = lines.deduplicate_lines(documents(spark, folder).select("doc_id", "text"))
    return shortened.select(
        "doc_id",
        F.col("__n_lines").alias("n_lines"),
        F.col("__n_dropped").alias("n_dropped"),
        F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("kept_sha256"),
    )


@query()
def op5_token_files(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "tokens")
    token_files.write_token_files(documents(spark, folder), path)
    return token_files.digests(spark, path)


@query()
def op6_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return transducer.token_counts(documents(spark, folder))


@query()
def op8_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(documents(spark, folder))


@query()
def op1_ann(spark: SparkSession, folder: str) -> DataFrame:
    vectors = spark.read.parquet(f"{folder}/embeddings.parquet")
    return ann.search(vectors, F.col("vec_id") % 20 == 0)


@query()
def op2_quality(spark: SparkSession, folder: str) -> DataFrame:
    return quality.score_documents(documents(spark, folder), spark.read.parquet(f"{folder}/labels.parquet"))


@query()
def op3_paragraph_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return paragraphs.repeated_passages(documents(spark, folder))


@query()
def op7_lm_scores(spark: SparkSession, folder: str) -> DataFrame:
    return hmm.score_documents(documents(spark, folder))


@query()
def op9_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return decontam.leaks(documents(spark, folder), spark.read.parquet(f"{folder}/benchmark.parquet"))


@query()
def op10_ngram_join(spark: SparkSession, folder: str) -> DataFrame:
    return ngram_join.jaccard_components(documents(spark, folder))


@query()
def op11_html_text(spark: SparkSession, folder: str) -> DataFrame:
    return pages.main_text(spark.read.parquet(f"{folder}/pages.parquet"))


@query()
def op12_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    return periodic.collapse_runs(documents(spark, folder))


@query()
def op13_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    vectors = spark.read.parquet(f"{folder}/embeddings.parquet")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.hard_negatives(vectors.withColumn("label", moved), F.col("vec_id") % 100 == 0)


@query()
def pipeline(spark: SparkSession, folder: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, folder)
