"""Nearest neighbours by a hierarchical k-means tree with best-bin-first search (operator 1).

The tree is fitted on a bounded sample and indexes every vector. Vectors get one more component that
makes all of equal length, so that the largest inner product becomes the least distance. A search
takes nodes from a priority queue, nearest centre first, until it has visited a number of leaves.
That number is calibrated: exact neighbours of some queries are found in all rows, and leaf visits
are widened until the wanted recall of them is reached, up to all leaves, which is exact search.
Leaves without rows are no visits, and a search goes on until the leaves hold k candidates.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from lakeops.session import written

BRANCHES = 16
LEAF_ROWS = 512
MOST_LEAVES = 4_096
SAMPLE = 20_000
CALIBRATION_QUERIES = 256
BLOCK_ROWS = 2_048
MOST_QUERIES_HELD = 20_000


def raised(vectors: np.ndarray, longest: float) -> np.ndarray:
    """With the component that brings each vector to the length ``longest``."""
    rest = np.sqrt(np.maximum(longest**2 - (vectors**2).sum(1), 0))
    return np.hstack((vectors, rest[:, None]))


def k_means(points: np.ndarray, count: int, random: np.random.Generator, rounds: int = 8) -> np.ndarray:
    centres = points[random.choice(len(points), count, replace=False)]
    for _ in range(rounds):
        nearest = (-2 * points @ centres.T + (centres**2).sum(1)).argmin(1)
        for k in range(count):
            own = points[nearest == k]
            if len(own):
                centres[k] = own.mean(0)
    return centres


class Tree:
    """Centres of inner nodes, node by node; leaves are numbered from 0."""

    def __init__(self, sample: np.ndarray, leaves: int, longest: float, seed: int = 5):
        self.longest, self.leaves = longest, 0
        self.centres: list[np.ndarray] = []
        self.children: list[list[int]] = []  # inner node n as n, leaf l as -1 - l
        random = np.random.default_rng(seed)
        self.root = self._grown(raised(sample, longest), leaves, random)

    def _grown(self, points: np.ndarray, leaves: int, random) -> int:
        count = min(BRANCHES, leaves, len(points))
        if count < 2:
            self.leaves += 1
            return -self.leaves
        number = len(self.centres)
        centres = k_means(points, count, random)
        self.centres.append(centres)
        self.children.append([])
        nearest = (-2 * points @ centres.T + (centres**2).sum(1)).argmin(1)
        for k in range(count):
            own = points[nearest == k]
            share = max(1, round(leaves * len(own) / len(points)))
            # A share of everything means that the points do not part: no deeper then.
            self.children[number].append(self._grown(own, share if len(own) < len(points) else 1, random))
        return number

    def leaf_of(self, vectors: np.ndarray) -> np.ndarray:
        """The leaf that each vector falls into."""
        points = raised(vectors, self.longest)
        found = np.empty(len(points), np.int64)
        stack = [(self.root, np.arange(len(points)))]
        while stack:
            node, rows = stack.pop()
            if node < 0:
                found[rows] = -1 - node
            elif len(rows):
                centres = self.centres[node]
                nearest = (-2 * points[rows] @ centres.T + (centres**2).sum(1)).argmin(1)
                stack += [(child, rows[nearest == k]) for k, child in enumerate(self.children[node])]
        return found

    def visited(self, query: np.ndarray, most: int, sizes: np.ndarray, least_rows: int = 0) -> list[int]:
        """The first leaves with rows of the search for a query, nearest centre first.

        They are ``most``, or more until they hold ``least_rows`` rows by the ``sizes`` of the leaves.
        """
        point = np.append(query, 0.0)
        queue, leaves, held = [(0.0, self.root)], [], 0
        while queue and (len(leaves) < most or held < least_rows):
            _, node = heapq.heappop(queue)
            if node < 0:
                if sizes[-1 - node]:
                    leaves.append(-1 - node)
                    held += int(sizes[-1 - node])
                continue
            distances = ((self.centres[node] - point) ** 2).sum(1)
            for distance, child in zip(distances.tolist(), self.children[node]):
                heapq.heappush(queue, (distance, child))
        return leaves


def best_of(queries, query_ids, vectors, vector_ids, k: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Query id, ids and scores of the k best rows of a block, ties to the smaller id.

    Scores that decide are summed row by row in one order, so equal vectors have equal scores.
    """
    if not len(vectors):
        return
    rough = queries @ vectors.T
    margin = 1e-9 * (1 + np.abs(rough).max(1))
    for row, query_id in enumerate(query_ids):
        own = rough[row]
        own[vector_ids == query_id] = -np.inf
        if len(own) > k:
            least = np.partition(own, len(own) - k)[len(own) - k]
            chosen = np.flatnonzero(own >= least - margin[row])
        else:
            chosen = np.arange(len(own))
        chosen = chosen[own[chosen] > -np.inf]
        scores = (vectors[chosen] * queries[row]).sum(1)
        order = np.lexsort((vector_ids[chosen], -scores))[:k]
        yield int(query_id), vector_ids[chosen][order], scores[order]


class Best:
    """The k best candidates of each query seen so far in a task."""

    def __init__(self, k: int):
        self.k, self.found = k, {}

    def add(self, query_id: int, ids: np.ndarray, scores: np.ndarray) -> None:
        if query_id in self.found:
            before_ids, before = self.found[query_id]
            ids, scores = np.concatenate((before_ids, ids)), np.concatenate((before, scores))
            order = np.lexsort((ids, -scores))[: self.k]
            ids, scores = ids[order], scores[order]
        self.found[query_id] = ids, scores

    def taken(self) -> pa.RecordBatch:
        queries = [np.full(len(ids), q, np.int64) for q, (ids, _) in self.found.items()]
        ids, scores = [i for i, _ in self.found.values()], [s for _, s in self.found.values()]
        self.found = {}
        joined = [np.concatenate(x) if x else np.empty(0) for x in (queries, ids, scores)]
        return pa.RecordBatch.from_arrays(
            [pa.array(joined[0].astype(np.int64)), pa.array(joined[1].astype(np.int64)), pa.array(joined[2])],
            names=["query_id", "vec_id", "score"],
        )


SCORED = "query_id long, vec_id long, score double"


def _matrix(batch: pa.RecordBatch, width: int) -> np.ndarray:
    return batch.column("vector").flatten().to_numpy(zero_copy_only=False).astype(float).reshape(-1, width)


def _usable(vectors: DataFrame) -> DataFrame:
    """``vec_id`` and ``vector`` of the rows that take part."""
    vector = F.col("embedding").cast("array<double>")

    def good(x: Column) -> Column:
        return x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))

    found = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), vector.alias("vector")).filter(
        F.col("vec_id").isNotNull() & F.forall("vector", good) & F.exists("vector", lambda x: x != 0)
    )
    widths = found.groupBy(F.size("vector").alias("width")).count().orderBy(F.desc("count"), "width").limit(1).collect()
    return found.filter(F.size("vector") == (widths[0]["width"] if widths else 1))


def _top(scored: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return scored.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def search(
    vectors: DataFrame, is_query: Column, k: int = 20, recall: float = 0.96, seed: int = 5
) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id``, ``score``: the k nearest found rows of each query row.

    Nearness is the inner product in double precision, ties go to the smaller id, and a query's own id
    is no neighbour of it. Vectors that are missing, zero, or hold a missing or non-finite component
    take no part, nor do rows without id or of another width than most. Rows that share an id are
    candidates each; as queries they are one, the largest vector. With fewer rows than k all are
    returned; an empty table gives no rows. Other columns are not read.
    """
    spark = vectors.sparkSession
    usable = written(_usable(vectors), "ann-vectors")
    length = F.sqrt(F.aggregate("vector", F.lit(0.0), lambda n, x: n + x * x))
    total, longest, width = usable.agg(F.count("*"), F.max(length), F.max(F.size("vector"))).first()
    if not total:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    share = F.pmod(F.xxhash64("vec_id", F.lit(seed)), F.lit(1_000_000)) < int(1e6 * min(1.0, SAMPLE / total))
    sample = usable.filter(share).select("vector").limit(2 * SAMPLE).toArrow()
    points = sample.column("vector").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
    tree = spark.sparkContext.broadcast(
        Tree(points.astype(float), max(1, min(MOST_LEAVES, total // LEAF_ROWS)), float(longest) * (1 + 1e-12))
    )

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            leaf = pa.array(tree.value.leaf_of(_matrix(batch, width)))
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), batch.column("vector"), leaf], names=["vec_id", "vector", "leaf"]
            )

    indexed = written(usable.mapInArrow(placed, "vec_id long, vector array<double>, leaf long"), "ann-index")
    # Rows with a query's own id are no candidates of it.
    repeated = indexed.groupBy("vec_id").agg(F.count("*").alias("own")).filter("own > 1")
    queries = (
        indexed.filter(is_query)
        .groupBy("vec_id")
        .agg(F.max("vector").alias("vector"))
        .join(repeated, "vec_id", "left")
        .select("vec_id", "vector", F.coalesce("own", F.lit(1)).alias("own"))
    )
    sizes = {r["leaf"]: r["count"] for r in indexed.groupBy("leaf").count().collect()}  # MOST_LEAVES at most
    held = spark.sparkContext.broadcast(np.array([sizes.get(leaf, 0) for leaf in range(tree.value.leaves)]))
    visits = _calibrated(indexed, queries, tree, held.value, width, k, recall)
    parts = spark.sparkContext.broadcast({leaf: -(-n // BLOCK_ROWS) for leaf, n in sizes.items()})

    def in_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The block of each row: its leaf, and one of the parts of a large leaf."""
        for batch in batches:
            counts = np.array([parts.value[leaf] for leaf in batch.column("leaf").to_pylist()], np.int64)
            mixed = batch.column("vec_id").to_numpy() * np.int64(0x9E3779B1) >> np.int64(7)
            columns = [batch.column(c) for c in ("vec_id", "vector", "leaf")] + [pa.array(mixed % np.maximum(counts, 1))]
            yield pa.RecordBatch.from_arrays(columns, names=["vec_id", "vector", "leaf", "part"])

    def packed(table: pa.Table) -> pa.Table:
        vectors = table.column("vector").combine_chunks().flatten().to_numpy(zero_copy_only=False)
        return pa.table(
            {
                "leaf": table.column("leaf")[:1],
                "part": table.column("part")[:1],
                "ids": pa.array([table.column("vec_id").to_numpy().tobytes()], pa.binary()),
                "rows": pa.array([vectors.astype("<f8").tobytes()], pa.binary()),
            }
        )

    def asked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """For each leaf the queries of a batch that visit it, for each part of the leaf."""
        for batch in batches:
            matrix, ids = _matrix(batch, width), batch.column("vec_id").to_numpy()
            by_leaf: dict[int, list[int]] = {}
            for row, (query, own) in enumerate(zip(matrix, batch.column("own").to_pylist())):
                for leaf in tree.value.visited(query, visits, held.value, k + own):
                    by_leaf.setdefault(leaf, []).append(row)
            rows = [(leaf, part, at) for leaf, at in by_leaf.items() for part in range(parts.value.get(leaf, 0))]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([r[0] for r in rows], pa.int64()),
                    pa.array([r[1] for r in rows], pa.int64()),
                    pa.array([ids[r[2]].tobytes() for r in rows], pa.binary()),
                    pa.array([matrix[r[2]].tobytes() for r in rows], pa.binary()),
                ],
                names=["leaf", "part", "query_ids", "queries"],
            )

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = Best(k)
        for batch in batches:
            for query_ids, wanted, ids, rows in zip(*(batch.column(c).to_pylist() for c in columns)):
                for found in best_of(
                    np.frombuffer(wanted).reshape(-1, width),
                    np.frombuffer(query_ids, np.int64),
                    np.frombuffer(rows).reshape(-1, width),
                    np.frombuffer(ids, np.int64),
                    k,
                ):
                    best.add(*found)
            if len(best.found) > MOST_QUERIES_HELD:
                yield best.taken()
        yield best.taken()

    columns = ["query_ids", "queries", "ids", "rows"]
    blocks = (
        indexed.mapInArrow(in_blocks, "vec_id long, vector array<double>, leaf long, part long")
        .groupBy("leaf", "part")
        .applyInArrow(packed, "leaf long, part long, ids binary, rows binary")
    )
    wanted = queries.mapInArrow(asked, "leaf long, part long, query_ids binary, queries binary")
    pairs = wanted.join(blocks, ["leaf", "part"]).select(*columns)
    return _top(pairs.mapInArrow(scored, SCORED), k).select("query_id", "rank", "vec_id", "score")


def _calibrated(
    indexed: DataFrame, queries: DataFrame, tree, sizes: np.ndarray, width: int, k: int, recall: float
) -> int:
    """How many leaves to visit for the wanted share of the exact neighbours of a few queries."""
    leaves = tree.value.leaves
    chosen = queries.orderBy(F.xxhash64("vec_id"), "vec_id").limit(CALIBRATION_QUERIES).collect()
    if leaves == 1 or not chosen:
        return leaves
    ids = np.array([r["vec_id"] for r in chosen], np.int64)
    matrix = np.array([r["vector"] for r in chosen], float)
    held = indexed.sparkSession.sparkContext.broadcast((ids, matrix))

    def exact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = Best(k)
        for batch in batches:
            vectors, own = _matrix(batch, width), batch.column("vec_id").to_numpy()
            for at in range(0, len(own), BLOCK_ROWS):
                part = slice(at, at + BLOCK_ROWS)
                for found in best_of(held.value[1], held.value[0], vectors[part], own[part], k):
                    best.add(*found)
        yield best.taken()

    truth = _top(indexed.select("vec_id", "vector").mapInArrow(exact, SCORED), k)
    rows = truth.join(indexed.select("vec_id", "leaf"), "vec_id").select("query_id", "leaf").collect()
    places = {
        i: {leaf: n for n, leaf in enumerate(tree.value.visited(query, leaves, sizes))}
        for i, query in zip(ids.tolist(), matrix)
    }
    ranks = np.sort([places[r["query_id"]][r["leaf"]] for r in rows])
    visits = 1
    while visits < leaves and np.searchsorted(ranks, visits) < recall * len(ranks):
        visits += 1
    return visits
