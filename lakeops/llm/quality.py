"""Quality scores: random Fourier features, ridge regression and isotonic calibration (operator 2).

Statistics of whole texts are mapped to random Fourier features, whose inner products approximate a
Gaussian kernel. Each partition of labelled rows sums its part of the normal equations; the sums are
added up row by row of the matrix and solved for ridge scores. Scores of a quarter of the labelled
rows, which the fit does not see, are calibrated by isotonic regression over bins of equal width.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from lakeops.llm.common import crc_remainder
from lakeops.session import written

FEATURES = 256
WIDTH = 3.0
RIDGE = 1e-3
BINS = 2_000
MOST_LABELLED = 50_000
_PUNCTUATION = np.array([c in b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~" for c in range(256)])
_GROUPS = [
    np.array([c in group for c in range(256)])
    for group in (
        b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz", b"0123456789", b" ", b"\n", b".", b",",
        b"!?", b"|", b"#$%&*@^~", b"<>{}[]()=\\/_", b"'\"`-:;+", bytes(range(128, 256)),
    )
]
_MATRIX = np.array(_GROUPS, float).T
N_STATISTICS = len(_GROUPS) + 11


def statistics(text: str | None) -> np.ndarray:
    """Numbers that describe a whole text; all 0 for an empty one."""
    result = np.zeros(N_STATISTICS)
    if not text:
        return result
    data = np.frombuffer(text.encode("utf-8", "replace"), np.uint8)
    result[: len(_GROUPS)] = np.sqrt(np.bincount(data, minlength=256) @ _MATRIX / len(data))
    words = text.split()
    if not words:
        return result
    n = len(words)
    counts = Counter(words)
    lengths = np.fromiter(map(len, words), np.int64, n)
    again = sum(map(str.__eq__, words, words[1:])) / n
    lines = text.split("\n")
    result[len(_GROUPS) :] = (
        np.log1p(n) / 10,
        np.log1p(len(lines)) / 5,
        lengths.mean() / 10,
        lengths.std() / 10,
        np.log1p(lengths.max()) / 5,
        len(counts) / n,
        np.sqrt(again),
        np.sqrt(max(counts.values()) / n),
        len(set(lines)) / len(lines),
        sum(map(str.isupper, words)) / n,
        sum(not w[-1].isalnum() for w in words) / n,
    )
    return result


class Scorer:
    """Statistics to scores: standardized, mapped to cosines, weighted and calibrated."""

    def __init__(self, mean, deviation, weights, edges, levels):
        random = np.random.default_rng(11)
        self.mean, self.deviation, self.weights = mean, deviation, weights
        self.directions = random.normal(0, 1 / WIDTH, (N_STATISTICS, FEATURES))
        self.phases = random.uniform(0, 2 * np.pi, FEATURES)
        self.edges, self.levels = edges, levels

    def features(self, rows: np.ndarray) -> np.ndarray:
        standard = np.clip((rows - self.mean) / self.deviation, -6, 6)
        cosines = np.sqrt(2 / FEATURES) * np.cos(standard @ self.directions + self.phases)
        return np.hstack((cosines, np.ones((len(rows), 1))))

    def raw(self, rows: np.ndarray) -> np.ndarray:
        return self.features(rows) @ self.weights

    def scores(self, rows: np.ndarray) -> np.ndarray:
        """Calibrated; a thousandth of the raw score parts the rows of one level."""
        if not len(rows):
            return np.empty(0)
        raw = self.raw(rows)
        return 0.999 * np.interp(raw, self.edges, self.levels) + 0.001 * np.clip(raw, 0, 1)


def table_of_statistics(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``stats`` of each row."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [statistics(text) for text in batch.column("text").to_pylist()]
            stats = pa.array(rows, pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), stats], names=["doc_id", "stats"])

    chosen = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return written(chosen.mapInArrow(counted, "doc_id long, stats array<double>"), "quality-statistics")


def _matrix(stats: list) -> np.ndarray:
    return np.array(stats, float).reshape(-1, N_STATISTICS)


def held_out(doc_id: str | Column = "doc_id") -> Column:
    return crc_remainder(doc_id, 3) == 1


def known_labels(labels: DataFrame) -> DataFrame:
    """``doc_id`` and ``label`` of the documents to learn from: the lowest label of each, none held out."""
    return (
        labels.filter(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out())
        .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
        .agg(F.min("quality").cast("double").alias("label"))
    )


def fit(table: DataFrame, known: DataFrame) -> Scorer:
    """Learn from the rows of ``table`` whose labels are ``known``.

    Without any label each score is a half; with one label only, all scores are near it.
    """
    spark = table.sparkSession
    fold = F.pmod(F.floor(F.crc32(F.col("doc_id").cast("string").cast("binary")) / 3), F.lit(4)) == 0
    rows = written(table.join(known, "doc_id").select("stats", "label", fold.alias("calibrates")), "quality-rows")
    places = [F.get("stats", i) for i in range(N_STATISTICS)]
    moments = rows.agg(
        F.count("label"), F.sum("label"), *(F.avg(p) for p in places), *(F.stddev_pop(p) for p in places)
    ).first()
    if not moments[0]:
        flat = np.zeros(N_STATISTICS)
        return Scorer(flat, flat + 1, np.zeros(FEATURES + 1), np.array([0.0, 1.0]), np.array([0.5, 0.5]))
    mean = np.array(moments[2 : 2 + N_STATISTICS], float)
    deviation = np.maximum(np.array(moments[2 + N_STATISTICS :], float), 1e-3)
    scorer = Scorer(mean, deviation, np.zeros(FEATURES + 1), None, None)
    shared = spark.sparkContext.broadcast(scorer)

    def summed(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((FEATURES + 1, FEATURES + 2))
        for frame in frames:
            features = shared.value.features(_matrix(frame["stats"].tolist()))
            total += features.T @ np.column_stack((features, frame["label"].to_numpy()))
        yield pd.DataFrame({"line": range(FEATURES + 1), "values": [row.tobytes() for row in total]})

    def added(frame: pd.DataFrame) -> pd.DataFrame:
        total = sum(np.frombuffer(v) for v in frame["values"])
        return pd.DataFrame({"line": frame["line"][:1], "values": [total.tobytes()]})

    parts = rows.filter("NOT calibrates").select("stats", "label").mapInPandas(summed, "line long, values binary")
    equations = parts.groupBy("line").applyInPandas(added, "line long, values binary").toPandas().sort_values("line")
    if not len(equations):
        equations = pd.DataFrame({"values": [np.zeros(FEATURES + 2).tobytes()] * (FEATURES + 1)})
    system = np.array([np.frombuffer(v) for v in equations["values"]])
    count = max(1.0, system[-1, -2])
    penalty = RIDGE * count * np.eye(FEATURES + 1)
    penalty[-1, -1] = 1e-9
    scorer.weights = np.linalg.solve(system[:, :-1] + penalty, system[:, -1])
    shared.unpersist()
    scorer.edges, scorer.levels = _calibrated(spark, rows, scorer, moments[1] / moments[0])
    return scorer


def _calibrated(spark: SparkSession, rows: DataFrame, scorer: Scorer, share: float) -> tuple[np.ndarray, np.ndarray]:
    """Edges and levels of the isotonic regression of labels on binned raw scores."""
    from pyspark.ml.regression import IsotonicRegression

    shared = spark.sparkContext.broadcast(scorer)

    def binned(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            if len(frame):
                raw = np.clip(shared.value.raw(_matrix(frame["stats"].tolist())), -1, 2)
                yield pd.DataFrame({"features": np.round((raw + 1) / 3 * BINS) / BINS * 3 - 1, "label": frame["label"]})

    bins = (
        rows.filter("calibrates")
        .select("stats", "label")
        .mapInPandas(binned, "features double, label double")
        .groupBy("features")
        .agg(F.avg("label").alias("label"), F.count("label").cast("double").alias("weight"))
    )
    # Two light rows with the share of label 1 keep small samples off 0 and 1 and never leave none.
    ends = spark.createDataFrame([(-1.0, share, 1.0), (2.0, share, 1.0)], "features double, label double, weight double")
    model = IsotonicRegression(weightCol="weight").fit(bins.union(ends).coalesce(1))
    edges, levels = np.array(model.boundaries), np.array(model.predictions)
    return edges, np.clip(levels, 0, 1)


def score(table: DataFrame, scorer: Scorer) -> DataFrame:
    """``doc_id`` and ``score`` for each row of a table of statistics."""
    shared = table.sparkSession.sparkContext.broadcast(scorer)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = shared.value.scores(_matrix(batch.column("stats").to_pylist()))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(values)], names=["doc_id", "score"])

    return table.mapInArrow(scored, "doc_id long, score double")


def score_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id``, ``held_out``, ``score``, ``predicted`` of each row of ``docs``.

    The score is 0 to 1, higher where label 1 is likelier. Rows whose crc32 of the id modulo 3 is 1
    are held out of learning; a missing id is not held out and has no label. Missing and empty texts
    have statistics of 0 and are scored like others. Repeated rows get equal scores. Of ``docs`` only
    ``doc_id`` and ``text`` are read, of ``labels`` only ``doc_id`` and ``quality``.
    """
    table = table_of_statistics(docs)
    return score(table, fit(table, known_labels(labels))).select(
        "doc_id",
        held_out().alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def good_documents(
    docs: DataFrame, labels: DataFrame, least: float = 0.5, most_labelled: int = MOST_LABELLED
) -> DataFrame:
    """The rows of ``docs`` whose text scores ``least`` or more, with all their columns.

    Learns from at most ``most_labelled`` of the labels, chosen by a hash of the id, so that they can be
    sent to the documents: no text is shuffled, and only texts with such a label are counted twice.
    Missing and empty texts are scored like others, by statistics of 0; rows without id are scored and
    have no label; very long texts are read whole; rows that repeat stay or go together. An empty table
    gives no rows; without labels every score is a half.
    """
    known = written(
        known_labels(labels).orderBy(F.xxhash64("doc_id"), "doc_id").limit(most_labelled), "quality-labels"
    )
    learned = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(
        F.broadcast(known.select("doc_id")), "doc_id"
    )
    scorer = docs.sparkSession.sparkContext.broadcast(fit(table_of_statistics(learned), known))

    @F.pandas_udf("double")
    def scored(texts: pd.Series) -> pd.Series:
        return pd.Series(scorer.value.scores(_matrix([statistics(t) for t in texts])))

    return docs.filter(scored("text") >= least)
