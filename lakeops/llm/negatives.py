"""Hard negatives by angular triangle filtering (operator 13).

Each usable row stores its norm and its angles to a few reference directions. For two rows at angles s
and t to one reference, the angle between them lies from |s - t| to min(s + t, 2 pi - s - t); the
narrowest interval over all references, through the cosine and times both norms, bounds their inner
product. Bounds are widened by more than rounding can move them. Scores are computed, in integers, only
for pairs whose bounds overlap what is asked for:

* positives: the upper bound reaches the k-th largest lower bound of the anchor's rows in the block;
* negatives: the bounds overlap a window of scores, and the upper bound reaches the k-th largest lower
  bound of the rows that surely lie in that window.

Rows are dealt to blocks by their nearest reference and a hash, so that the angles of a block are
alike and a block can be passed over whole; anchors go to every block, in blocks of their own. Each
block returns the first k of an anchor, and the first k of those are the result: no limit drops a row
that could be among them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from lakeops.session import written

REFERENCES = 16
SAMPLE = 2_000
LEAST_BLOCK, MOST_BLOCK, WANTED_BLOCKS = 512, 8_192, 64
ANCHOR_BLOCK = 2_048
PAIRS_AT_ONCE = 1_000_000
#: More than the rounding errors of norms, angles and cosines of up to a million components.
ANGLE_SLACK = 1e-6
#: Integer-valued sums below this are exact in doubles, in any order.
EXACT = 2.0**53
#: Largest squared norm: any two rows' score then fits a long.
MOST_SQUARED = 2.0**62


def _usable(vectors: DataFrame, scale: int) -> DataFrame:
    """``vec_id``, ``label`` and integer ``vector`` (as doubles) of the rows that take part."""

    def good(x: Column) -> Column:
        return x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))

    scaled = F.transform("embedding", lambda x: F.floor(x.cast("double") * scale).cast("double"))
    found = vectors.filter(
        F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.forall("embedding", good)
    ).select(F.col("vec_id").cast("long"), F.col("label").cast("long"), scaled.alias("vector"))
    squared = F.aggregate("vector", F.lit(0.0), lambda n, x: n + x * x)
    rows = written(found.filter(squared < MOST_SQUARED), "negatives-rows")
    repeated = rows.groupBy("vec_id").agg(F.count("*").alias("__rows")).filter("__rows > 1").select("vec_id")
    one_each = (
        rows.join(repeated, "vec_id", "left_semi")
        .groupBy("vec_id")
        .agg(F.min(F.struct("label", "vector")).alias("__row"))
        .select("vec_id", "__row.*")
    )
    return rows.join(repeated, "vec_id", "left_anti").unionByName(one_each)


def unit_rows(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows of length 1 (0 for a row of zeros), and their norms."""
    norms = np.sqrt((matrix * matrix).sum(axis=1))
    return matrix / np.where(norms > 0, norms, 1)[:, None], norms


def reference_directions(sample: np.ndarray, wanted: int) -> np.ndarray:
    """Directions of rows far from each other: each next one is the row at the largest angle to its nearest."""
    rows = unit_rows(sample)[0]
    rows = rows[(rows != 0).any(axis=1)]
    if not len(rows):
        return np.zeros((0, sample.shape[1]))
    chosen = [0]
    nearest = rows @ rows[0]
    while len(chosen) < wanted:
        furthest = int(nearest.argmin())
        if nearest[furthest] > 1 - 1e-9:
            break
        chosen.append(furthest)
        nearest = np.maximum(nearest, rows @ rows[furthest])
    return rows[chosen]


def angles_to(references: np.ndarray, matrix: np.ndarray) -> np.ndarray:
    """The angle of each row to each reference."""
    return np.arccos(np.clip(unit_rows(matrix)[0] @ references.T, -1, 1))


def score_bounds(
    norms: np.ndarray, angles: np.ndarray, other_norms: np.ndarray, other_angles: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Lower and upper bounds of the inner products of all rows with all other rows."""
    least = np.zeros((len(norms), len(other_norms)))
    most = np.full_like(least, np.pi)
    for one, other in zip(angles.T, other_angles.T):
        np.maximum(least, np.abs(one[:, None] - other[None, :]), out=least)
        total = one[:, None] + other[None, :]
        np.minimum(most, np.minimum(total, 2 * np.pi - total), out=most)
    product = norms[:, None] * other_norms[None, :]
    lower = product * np.cos(np.minimum(most + ANGLE_SLACK, np.pi))
    upper = product * np.cos(np.maximum(least - ANGLE_SLACK, 0))
    slack = 1 + 1e-9 * product
    return lower - slack, upper + slack


def integer_scores(rows: np.ndarray, others: np.ndarray) -> np.ndarray:
    """Exact inner products of rows with the others beside them."""
    largest = np.sqrt((rows * rows).sum(axis=1).max(initial=0) * (others * others).sum(axis=1).max(initial=0))
    if largest * rows.shape[1] ** 0.5 < EXACT / 4 and (np.abs(rows) < 2**31).all() and (np.abs(others) < 2**31).all():
        # All partial sums stay below the norms' product times the root of the width.
        return np.einsum("ij,ij->i", rows, others).astype(np.int64)
    return np.array(
        [sum(int(a) * int(b) for a, b in zip(one, other)) for one, other in zip(rows.tolist(), others.tolist())], np.int64
    )


def _kth_largest(values: np.ndarray, usable: np.ndarray, k: int) -> np.ndarray:
    """The k-th largest usable value of each row; -inf if there are fewer."""
    if values.shape[1] < k:
        return np.full(len(values), -np.inf)
    masked = np.where(usable, values, -np.inf)
    return np.partition(masked, masked.shape[1] - k, axis=1)[:, masked.shape[1] - k]


class Block:
    """Rows of a block, or anchors: ids, labels, vectors, norms and angles."""

    def __init__(self, table: pa.Table, width: int):
        self.ids = table.column("vec_id").to_numpy()
        self.labels = table.column("label").to_numpy()
        flat = table.column("vector").combine_chunks().flatten().to_numpy(zero_copy_only=False)
        self.vectors = flat.astype(float).reshape(len(self.ids), width)
        angles = table.column("angles").combine_chunks().flatten().to_numpy(zero_copy_only=False)
        self.angles = angles.reshape(len(self.ids), -1)
        self.norms = np.sqrt((self.vectors * self.vectors).sum(axis=1))

    def bounds(self, some: slice, rows: "Block") -> tuple[np.ndarray, np.ndarray]:
        return score_bounds(self.norms[some], self.angles[some], rows.norms, rows.angles)

    def scores(self, pairs: tuple[np.ndarray, np.ndarray], rows: "Block") -> np.ndarray:
        mine, theirs = pairs
        step = max(1, PAIRS_AT_ONCE * 8 // max(1, self.vectors.shape[1]))
        parts = [
            integer_scores(self.vectors[mine[at : at + step]], rows.vectors[theirs[at : at + step]])
            for at in range(0, len(mine), step)
        ]
        return np.concatenate(parts) if parts else np.empty(0, np.int64)


def first_by_score(groups: np.ndarray, scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the first k of each group, by falling score and rising id."""
    order = np.lexsort((ids, -scores, groups))
    ordered = groups[order]
    begins = np.concatenate(([True], ordered[1:] != ordered[:-1])) if len(order) else np.empty(0, bool)
    starts = np.maximum.accumulate(np.where(begins, np.arange(len(order)), 0))
    return order[np.arange(len(order)) - starts < k]


def _steps(anchors: int, rows: int) -> Iterator[slice]:
    step = max(1, PAIRS_AT_ONCE // max(1, rows))
    for at in range(0, anchors, step):
        yield slice(at, at + step)


def block_positives(anchors: Block, rows: Block, k: int) -> dict[str, np.ndarray]:
    """The first k other rows of an anchor's label in a block, for each anchor."""
    found = []
    for some in _steps(len(anchors.ids), len(rows.ids)):
        alike = (anchors.labels[some][:, None] == rows.labels[None, :]) & (anchors.ids[some][:, None] != rows.ids[None, :])
        lower, upper = anchors.bounds(some, rows)
        mine, theirs = np.nonzero(alike & (upper >= _kth_largest(lower, alike, k)[:, None]))
        mine = mine + some.start
        scores = anchors.scores((mine, theirs), rows)
        kept = first_by_score(mine, scores, rows.ids[theirs], k)
        found.append((anchors.ids[mine[kept]], rows.ids[theirs[kept]], scores[kept]))
    ids, others, scores = (np.concatenate(x) for x in zip(*found)) if found else [np.empty(0, np.int64)] * 3
    return {"anchor_id": ids, "positive_id": others, "positive_score": scores}


PAIR = ("anchor_id", "positive_id", "negative_id", "positive_score", "negative_score")


def block_negatives(
    anchors: Block, positives: list[tuple[list[int], list[int]]], rows: Block, k: int, window: tuple[int, int]
) -> dict[str, np.ndarray]:
    """For each anchor and positive the first k rows of another label in a block whose score fits.

    ``positives`` has the ids and scores of each anchor's positives; ``window`` the percents of a
    positive's score that a negative's may have.
    """
    columns: dict[str, list] = {c: [] for c in PAIR}
    low, high = window
    for some in _steps(len(anchors.ids), len(rows.ids)):
        # Blocks that no window of an anchor reaches are not looked at pair by pair.
        lower, upper = anchors.bounds(some, rows)
        differ = anchors.labels[some][:, None] != rows.labels[None, :]
        known: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        wanted = np.zeros_like(differ)
        windows = []
        for at in range(lower.shape[0]):
            ids, scores = positives[some.start + at]
            for positive, score in zip(ids, scores):
                least, most = low * score / 100, high * score / 100
                least, most = least - abs(least) * 1e-9 - 1, most + abs(most) * 1e-9 + 1
                if least > most:  # a negative positive score leaves a window only if it is empty
                    continue
                may = differ[at] & (upper[at] >= least) & (lower[at] <= most)
                if not may.any():
                    continue
                surely = differ[at] & (lower[at] >= least + 2 + abs(least) * 4e-9) & (upper[at] <= most - 2 - abs(most) * 4e-9)
                floor = _kth_largest(lower[at][None, :], surely[None, :], k)[0]
                may &= upper[at] >= floor
                wanted[at] |= may
                windows.append((at, positive, score, may))
        mine, theirs = np.nonzero(wanted)
        scores = anchors.scores((mine + some.start, theirs), rows)
        edges = np.searchsorted(mine, np.arange(lower.shape[0] + 1))
        for at in range(lower.shape[0]):
            part = slice(edges[at], edges[at + 1])
            known[at] = (theirs[part], scores[part])
        for at, positive, score, may in windows:
            places, values = known[at]
            # Whole numbers of any size: a hundred scores could pass a long.
            fits = may[places] & (values >= -(-low * score // 100)) & (values <= high * score // 100)
            places, values = places[fits], values[fits]
            kept = first_by_score(np.zeros(len(places), np.int64), values, rows.ids[places], k)
            columns["anchor_id"].append(np.full(len(kept), anchors.ids[some.start + at]))
            columns["positive_id"].append(np.full(len(kept), positive))
            columns["negative_id"].append(rows.ids[places[kept]])
            columns["positive_score"].append(np.full(len(kept), score))
            columns["negative_score"].append(values[kept])
    return {c: np.concatenate(v).astype(np.int64) if v else np.empty(0, np.int64) for c, v in columns.items()}


ROW = "vec_id long, label long, vector array<double>, angles array<double>, width int, nearest int"


def _placed(usable: DataFrame) -> DataFrame:
    """Each row with its angles to the references of its width, and the number of the nearest."""
    drawn: dict[int, list] = {}
    for row in usable.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE).select("vector").collect():
        drawn.setdefault(len(row["vector"]), []).append(row["vector"])
    references = usable.sparkSession.sparkContext.broadcast(
        {w: reference_directions(np.array(rows, float).reshape(len(rows), w), REFERENCES) for w, rows in drawn.items()}
    )

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            widths = np.diff(batch.column("vector").offsets.to_numpy())
            for width in np.unique(widths).tolist():
                part = batch.filter(pa.array(widths == width))
                matrix = part.column("vector").flatten().to_numpy(zero_copy_only=False).reshape(part.num_rows, width)
                known = references.value.get(width, np.zeros((0, width)))
                angles = angles_to(known, matrix)
                nearest = angles.argmin(axis=1) if len(known) else np.zeros(len(matrix), np.int64)
                offsets = np.arange(0, angles.size + 1, len(known)) if len(known) else np.zeros(len(matrix) + 1)
                yield pa.RecordBatch.from_arrays(
                    [
                        *(part.column(c) for c in ("vec_id", "label", "vector")),
                        pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(angles.ravel(), pa.float64())),
                        pa.array(np.full(len(matrix), width), pa.int32()),
                        pa.array(nearest, pa.int32()),
                    ],
                    names=["vec_id", "label", "vector", "angles", "width", "nearest"],
                )

    return written(usable.mapInArrow(placed, ROW), "negatives-angles")


KEY = ("width", "nearest", "part", "anchor_part")


def _table(columns: dict[str, np.ndarray]) -> pa.Table:
    return pa.table({c: pa.array(v, pa.int64()) for c, v in columns.items()})


def _first(found: DataFrame, group: list[str], score: str, other: str, k: int) -> DataFrame:
    order = Window.partitionBy(*group).orderBy(F.desc(score), other)
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def hard_negatives(
    vectors: DataFrame,
    is_anchor: Column,
    n_positives: int = 5,
    n_negatives: int = 10,
    window: tuple[int, int] = (30, 90),
    scale: int = 256,
) -> DataFrame:
    """``anchor_id``, ``positive_id``, ``rank``, ``negative_id``, ``positive_score``, ``negative_score``.

    A component x counts as floor(scale * x); a score is the integer inner product with the anchor.
    Positives are an anchor's first other rows of its label, by falling score and rising id; negatives
    the first rows of another label whose score is within ``window`` percent of the positive's. Rows
    without id, label or vector, or with a missing or non-finite component, take no part, nor do rows
    whose scores could pass a long (squared norm of 2**62 or more). Rows of different widths have no
    score and never meet. Of rows that share an id the one of the smallest label and vector counts.
    ``is_anchor`` may use ``vec_id`` and ``label``. An anchor without positives, a positive without
    negatives and an empty table give no rows; other columns are not read.
    """
    rows = _placed(_usable(vectors, scale))
    anchors = rows.filter(is_anchor)
    total = rows.count()
    block_rows = min(MOST_BLOCK, max(LEAST_BLOCK, total // WANTED_BLOCKS))

    def parts(of: DataFrame, by: list[str], size: int, name: str) -> DataFrame:
        return of.groupBy(*by).agg(F.ceil(F.count("*") / size).alias(name))

    row_parts = written(parts(rows, ["width", "nearest"], block_rows, "parts"), "negatives-blocks")
    anchor_parts = written(parts(anchors, ["width"], ANCHOR_BLOCK, "anchor_parts"), "negatives-blocks")

    def numbers(upto: str) -> Column:
        return F.explode(F.sequence(F.lit(0).cast("long"), F.col(upto) - 1))

    blocks = (
        rows.join(row_parts, ["width", "nearest"])
        .withColumn("part", F.pmod(F.xxhash64("vec_id"), F.col("parts")))
        .join(anchor_parts, "width")
        .withColumn("anchor_part", numbers("anchor_parts"))
    )
    asking = (
        anchors.join(anchor_parts, "width")
        .withColumn("anchor_part", F.pmod(F.xxhash64("vec_id"), F.col("anchor_parts")))
        .drop("nearest")
        # Each anchor goes to every block of rows: the stated queries against all rows, in blocks.
        .join(row_parts.withColumn("part", numbers("parts")), "width")
    )
    columns = ["vec_id", "label", "vector", "angles", *KEY]
    # Columns of their own, as both sides of the cogroups come from one table.
    fresh = [F.col(c).alias(c) for c in columns]

    def positives(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return _table({"anchor_id": [], "positive_id": [], "positive_score": []})
        width = left.column("width")[0].as_py()
        return _table(block_positives(Block(left, width), Block(right, width), n_positives))

    found = (
        asking.select(*fresh)
        .groupBy(*KEY)
        .cogroup(blocks.select(*columns).groupBy(*KEY))
        .applyInArrow(positives, "anchor_id long, positive_id long, positive_score long")
    )
    chosen = written(_first(found, ["anchor_id"], "positive_score", "positive_id", n_positives), "negatives-positives")
    pairs = chosen.groupBy(F.col("anchor_id").alias("vec_id")).agg(
        F.sort_array(F.collect_list(F.struct("rank", "positive_id", "positive_score"))).alias("positives")
    )
    # The exchange of an anchor's copies carries its few positives along.
    asking = asking.join(pairs, "vec_id").select(
        *fresh, F.col("positives.positive_id").alias("positive_ids"), F.col("positives.positive_score").alias("scores")
    )

    def negatives(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return _table({c: [] for c in PAIR})
        width = left.column("width")[0].as_py()
        known = list(zip(left.column("positive_ids").to_pylist(), left.column("scores").to_pylist()))
        return _table(block_negatives(Block(left, width), known, Block(right, width), n_negatives, window))

    found = (
        asking.groupBy(*KEY)
        .cogroup(blocks.select(*columns).groupBy(*KEY))
        .applyInArrow(negatives, ", ".join(f"{c} long" for c in PAIR))
    )
    ranked = _first(found, ["anchor_id", "positive_id"], "negative_score", "negative_id", n_negatives)
    return ranked.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
