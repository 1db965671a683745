"""Periodic runs of words, found at scales and stitched together (operator 12).

A run is a longest stretch of words with smallest period q (words q apart are identical), as long as
four periods and six words at least. Periods are dealt to octaves: octave k holds q from 2**k up to
2**(k+1). For each octave

1. a document is cut into tiles that overlap by the reach of the octave; within a tile a boundary lies
   at every 2**k words. A run of the octave has a boundary at which a gram of 2**(k+1) words begins
   whose nearest earlier copy starts q words before. Tiles look for that copy at their boundaries
   only, so an octave costs a fixed number of comparisons a word.
2. At a boundary with such a copy the values of the Z-functions of both sides for period q, that is how
   far the words after the gram and before its copy agree q words apart, give a fragment of the run.
   They are followed for 2**k words, where the next tile or boundary knows better.
3. Fragments are shuffled by document and period and stitched where they touch or overlap. What holds
   more copies of a shorter period never shows up under a longer one: its nearest copy is nearer.

Tiles are cut and solved where the document lies, so that only fragments travel; texts travel a second
time only for documents with fragments, to drop the repeated words.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from lakeops.llm.common import BLANKS
from lakeops.session import written

LEAST_WORDS = 6
LEAST_PERIODS = 4
TILE_WORDS = 4_096
BATCH_WORDS = 500_000
_TO_SPACE = str.maketrans(BLANKS, " " * len(BLANKS))


def words_as_written(text: str | None) -> list[str]:
    """Words between blanks, their case kept."""
    return [w for w in text.translate(_TO_SPACE).split(" ") if w] if text else []


def planted(words: list[str], checksum: int | None) -> list[str]:
    """The words a document is searched with: one in ten, by its checksum, gets a periodic tail."""
    n = len(words)
    if checksum is None or checksum % 10 or not n:
        return words
    g = checksum // 10
    first = g % n
    period = 1 + (n - first) // (3 + g % 8)
    base = words[first : first + period]
    return words[:first] + (base * ((n - first) // period + 1))[: n - first]


def _mixed(values: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        values = (values ^ (values >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15)
        return values ^ (values >> np.uint64(32))


def boundary_reach(ids: np.ndarray, at: int, period: int, most: int) -> int:
    """How many words from ``at`` on equal the word ``period`` later: the Z-function there, up to ``most``."""
    stop = min(at + most, len(ids) - period)
    differ = np.flatnonzero(ids[at:stop] != ids[at + period : stop + period])
    return int(differ[0]) if len(differ) else max(0, stop - at)


def boundary_reach_back(ids: np.ndarray, at: int, period: int, most: int) -> int:
    """The same for the words before ``at``, away from it."""
    stop = max(at - most, 0)
    differ = np.flatnonzero(ids[stop:at] != ids[stop + period : at + period])
    return at - stop - 1 - int(differ[-1]) if len(differ) else at - stop


def nearest_copies(grams: np.ndarray, stride: int) -> tuple[np.ndarray, np.ndarray]:
    """Boundaries, multiples of ``stride``, whose gram has its nearest earlier copy ``stride`` to
    ``2 * stride - 1`` places before; and that distance."""
    boundaries = np.arange(0, len(grams), stride)
    found, distances = [], []
    # Rows of distances by boundaries are compared in pieces of bounded size.
    step = max(1, 2_000_000 // (2 * stride))
    for at in range(0, len(boundaries), step):
        some = boundaries[at : at + step]
        places = some[:, None] - np.arange(1, 2 * stride)[None, :]
        same = (grams[np.maximum(places, 0)] == grams[some][:, None]) & (places >= 0)
        nearest = same.argmax(axis=1) + 1
        hit = same[np.arange(len(some)), nearest - 1] & (nearest >= stride)
        found.append(some[hit])
        distances.append(nearest[hit])
    return np.concatenate(found), np.concatenate(distances)


def fragments(ids: np.ndarray, starts: np.ndarray) -> list[tuple[int, int, int, int]]:
    """(document, period, start, end) of parts of runs in documents laid end to end.

    ``starts`` has the place of the first word of each document and, last, the total. ``start`` and
    ``end`` bound the words that equal the word one period later, counted from the document's start.
    """
    result: list[tuple[int, int, int, int]] = []
    lengths = np.diff(starts)
    stride = 1
    while True:
        chosen = np.flatnonzero(lengths >= max(LEAST_WORDS, LEAST_PERIODS * stride))
        if not len(chosen):
            return result
        result += _octave(ids, starts, chosen, stride)
        stride *= 2


def _octave(ids: np.ndarray, starts: np.ndarray, chosen: np.ndarray, stride: int) -> list[tuple[int, int, int, int]]:
    # Long enough documents, each behind words of its own so that no gram reaches across a border.
    parts, begins, at = [], [], 0
    unique = int(ids.max()) + 1 if len(ids) else 0
    for number in chosen.tolist():
        # Each document begins at a boundary.
        parts.append(ids[starts[number] : starts[number + 1]])
        begins.append(at)
        length = len(parts[-1])
        padding = -length % stride + 2 * stride
        parts.append(np.arange(unique, unique + padding))
        unique += padding
        at += length + padding
    joined = np.concatenate(parts)
    grams, width = _mixed(joined.astype(np.uint64) + np.uint64(1)), 1
    while width < 2 * stride:
        with np.errstate(over="ignore"):
            grams = _mixed(grams[:-width] * np.uint64(0xC2B2AE3D27D4EB4F) + grams[width:])
        width *= 2
    boundaries, periods = nearest_copies(grams, stride)
    if not len(boundaries):
        return []
    begins = np.array(begins)
    owner = np.searchsorted(begins, boundaries, "right") - 1
    tile = (boundaries - begins[owner]) // max(TILE_WORDS, 8 * stride)
    # Neighbouring boundaries of a tile with one period share their fragment.
    new = np.flatnonzero(
        (np.diff(boundaries) != stride) | (np.diff(periods) != 0) | (np.diff(owner) != 0) | (np.diff(tile) != 0)
    )
    firsts, lasts = np.concatenate(([0], new + 1)), np.concatenate((new, [len(boundaries) - 1]))
    found = []
    for first, last in zip(firsts.tolist(), lasts.tolist()):
        period, begin = int(periods[first]), int(begins[owner[first]])
        start, end = int(boundaries[first]) - period, int(boundaries[last]) - period + 2 * stride
        start -= boundary_reach_back(joined, start, period, min(stride, start - begin))
        end += boundary_reach(joined, end, period, stride)
        found.append((int(chosen[owner[first]]), period, start - begin, end - begin))
    return found


def enough(found: list[dict]) -> list[dict]:
    """The fragments of periods of which there is as much, in all, as a run needs."""
    covered: dict[int, int] = {}
    for f in found:
        covered[f["period"]] = covered.get(f["period"], f["period"]) + f["end"] - f["start"]
    return [f for f in found if covered[f["period"]] >= max(LEAST_WORDS, LEAST_PERIODS * f["period"])]


def _searched(docs: DataFrame) -> DataFrame:
    """One row for each document: the digest of its words, its fragments, and its words if it has any."""

    def solved(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = pa.Codec("zstd")
        for batch in batches:
            at = 0
            while at < batch.num_rows:
                taken, held, known = [], 0, {}
                fresh = count()
                ids, starts = [], [0]
                while at + len(taken) < batch.num_rows and held < BATCH_WORDS:
                    row = at + len(taken)
                    words = planted(
                        words_as_written(batch.column("text")[row].as_py()), batch.column("checksum")[row].as_py()
                    )
                    for word in words:
                        if word not in known:
                            known[word] = next(fresh)
                    ids.append(np.fromiter(map(known.__getitem__, words), np.int64, len(words)))
                    held += len(words)
                    starts.append(held)
                    taken.append(" ".join(words).encode("utf-8", "surrogatepass"))
                by_row: list[list] = [[] for _ in taken]
                for row, period, start, end in fragments(np.concatenate(ids), np.array(starts)):
                    by_row[row].append({"period": period, "start": start, "end": end})
                by_row = [enough(found) for found in by_row]
                part = batch.slice(at, len(taken))
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"),
                        part.column("row"),
                        pa.array([hashlib.sha256(t).hexdigest() for t in taken], pa.string()),
                        pa.array([len(t) for t in taken], pa.int64()),
                        # Periodic texts are stored and shuffled at a fraction of their size.
                        pa.array([codec.compress(t, asbytes=True) if f else None for t, f in zip(taken, by_row)], pa.binary()),
                        pa.array(by_row, pa.list_(pa.struct([(c, pa.int64()) for c in ("period", "start", "end")]))),
                    ],
                    names=["doc_id", "row", "digest", "n_bytes", "words", "fragments"],
                )
                at += len(taken)

    return written(
        docs.select(
            F.col("doc_id").cast("long").alias("doc_id"),
            F.xxhash64("text").alias("row"),
            F.col("text").cast("string").alias("text"),
            F.when(F.col("doc_id").isNotNull(), F.crc32(F.col("doc_id").cast("long").cast("string").cast("binary"))).alias(
                "checksum"
            ),
        ).mapInArrow(
            solved,
            "doc_id long, row long, digest string, n_bytes long, words binary, "
            "fragments array<struct<period: bigint, start: bigint, end: bigint>>",
        ),
        "periodic-fragments",
    )


def stitched(pieces: DataFrame) -> DataFrame:
    """``doc_id``, ``row``, ``start``, ``length``, ``period`` of each run, from fragments of documents.

    Rows that repeat have equal fragments, which stitch to the same runs.
    """
    ahead = (
        Window.partitionBy("doc_id", "row", "period").orderBy("start", "end").rowsBetween(Window.unboundedPreceding, -1)
    )
    ordered = Window.partitionBy("doc_id", "row", "period").orderBy("start", "end")
    islands = pieces.withColumn("reached", F.max("end").over(ahead)).withColumn(
        "island", F.sum((F.col("reached").isNull() | (F.col("start") > F.col("reached"))).cast("long")).over(ordered)
    )
    length = F.max("end") + F.col("period") - F.min("start")
    return (
        islands.groupBy("doc_id", "row", "period", "island")
        .agg(F.min("start").alias("start"), length.alias("length"))
        .filter((F.col("length") >= LEAST_WORDS) & (F.col("length") >= LEAST_PERIODS * F.col("period")))
        .select("doc_id", "row", "start", "length", "period")
    )


def periodic_runs(docs: DataFrame) -> DataFrame:
    """Each run of each document: ``doc_id``, ``row`` (a hash of the text), ``start``, ``length``, ``period``."""
    return _runs_of(_searched(docs))


def _runs_of(searched: DataFrame) -> DataFrame:
    pieces = searched.filter("words IS NOT NULL").select("doc_id", "row", F.explode("fragments").alias("f"))
    return stitched(pieces.select("doc_id", "row", "f.*"))


def collapse_runs(docs: DataFrame) -> DataFrame:
    """For each row ``doc_id``, ``n_runs``, the run of most periods (``start``, ``length``, ``period``,
    ``exponent_milli``) and digests of all runs and of the words that stay.

    A word goes if any run holds it after the run's first period. Words stand between blanks and keep
    their case. Missing, empty and blank texts have no words and no run. One document in ten, by the
    checksum of its id, is searched with a planted periodic tail; a missing id plants none. Rows that
    repeat give equal rows. Very long texts are searched whole, in a task each, in time n log n. An
    empty table gives no rows; other columns are not read.
    """
    searched = _searched(docs)
    run = F.struct("start", "length", "period")
    exponent = F.col("length") / F.col("period")
    runs = written(
        _runs_of(searched)
        .groupBy(F.col("doc_id").alias("__id"), F.col("row").alias("__row"))
        .agg(
            F.sort_array(F.collect_list(F.struct("start", "period", "length"))).alias("runs"),
            F.max_by(run, F.struct(exponent, -F.col("start"), -F.col("period"))).alias("top"),
        ),
        "periodic-runs",
    )
    written_out = F.concat_ws(
        "", F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], F.concat(r["period"], F.lit("\n"))))
    )
    same = F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("row") == F.col("__row"))
    searched_with = searched.filter("words IS NOT NULL").drop("fragments").join(runs, same, "left")

    def collapsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = pa.Codec("zstd")
        for batch in batches:
            digests = []
            for digest, size, packed, runs in zip(*(batch.column(c) for c in ("digest", "n_bytes", "words", "runs"))):
                spans = runs.as_py()
                if spans:
                    words = codec.decompress(packed.as_py(), size.as_py(), asbytes=True).split(b" ")
                    stays = np.ones(len(words), bool)
                    for span in spans:
                        stays[span["start"] + span["period"] : span["start"] + span["length"]] = False
                    kept = b" ".join([words[i] for i in np.flatnonzero(stays).tolist()])
                    digests.append(hashlib.sha256(kept).hexdigest())
                else:
                    digests.append(digest.as_py())
            columns = {c: batch.column(c) for c in ("doc_id", "n_runs", "start", "length", "period", "runs_sha256")}
            yield pa.RecordBatch.from_pydict({**columns, "collapsed_sha256": pa.array(digests, pa.string())})

    found = searched_with.select(
        "doc_id",
        "digest",
        "n_bytes",
        "words",
        "runs",
        F.coalesce(F.size("runs"), F.lit(0)).cast("long").alias("n_runs"),
        "top.*",
        F.sha2(F.coalesce(F.when(F.col("runs").isNotNull(), written_out), F.lit("")).cast("binary"), 256).alias("runs_sha256"),
    ).mapInArrow(
        collapsed,
        "doc_id long, n_runs long, start long, length long, period long, runs_sha256 string, collapsed_sha256 string",
    )
    none = F.lit(None).cast("long")
    plain = searched.filter("words IS NULL").select(
        "doc_id",
        F.lit(0).cast("long").alias("n_runs"),
        none.alias("start"),
        none.alias("length"),
        none.alias("period"),
        F.sha2(F.lit("").cast("binary"), 256).alias("runs_sha256"),
        F.col("digest").alias("collapsed_sha256"),
    )
    return plain.unionByName(found).select(
        "doc_id",
        "n_runs",
        "start",
        "length",
        "period",
        F.expr("1000 * length div period").alias("exponent_milli"),
        "runs_sha256",
        "collapsed_sha256",
    )
