"""Packing of documents into training sequences with their lexical neighbours (operator 8).

Document frequencies and the mean length are those of the whole table. Documents are placed by what
they hold: random projections of their BM25 weights fall into the leaves of a k-means tree fitted on
a bounded sample, and neighbouring leaves make a shard. A leaf that is larger than a shard is dealt
over several by a hash.

Each shard is one task's inverted index with BM25 weights: a seed document opens a window, its
best-scoring unused neighbours fill it in turn, and the document that is cut at the window's end
opens the next window with its rest. Neighbours that the tree puts into other shards are not found;
the README gives their share.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from lakeops.llm.ann import Tree
from lakeops.llm.tokens import default_path, vocabulary_size, word_tokenizer
from lakeops.session import written

PIECE = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
)
K1, B = 1.2, 0.75
DIMENSIONS = 64
SAMPLE = 20_000
LEAVES_A_SHARD = 4
#: Tokens whose documents are sorted at once.
AT_ONCE = 1 << 19
#: The share of a shard's documents from which on a term has a weight for each of them.
OFTEN = 0.1
#: Neighbours that are sorted before the others; a window seldom takes more.
FIRST_TAKEN = 32


def inverse_frequency(documents: int, held: np.ndarray) -> np.ndarray:
    """BM25's weight of terms; those of more than half of the documents have none in this formula."""
    return np.maximum(np.log((documents - held + 0.5) / (held + 0.5)), 0)


def distinct(documents: list[np.ndarray]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """The different terms of each document, in order, and how often it holds each; some documents at a time.

    A tuple has the terms and times of its documents one after the other, and where each document begins
    and the last one ends.
    """
    first, lengths = 0, np.array([len(ids) for ids in documents], np.int64)
    ends = np.cumsum(lengths)
    while first < len(documents):
        after = max(first + 1, int(np.searchsorted(ends, ends[first] - lengths[first] + AT_ONCE, "right")))
        rows = np.repeat(np.arange(after - first, dtype=np.uint64), lengths[first:after])
        keys = (rows << np.uint64(32)) | np.concatenate(documents[first:after])
        keys.sort()
        new = np.flatnonzero(np.concatenate((np.ones(min(len(keys), 1), bool), keys[1:] != keys[:-1])))
        times, keys = np.diff(new, append=len(keys)), keys[new]
        bounds = np.searchsorted(keys, np.arange(after - first + 1, dtype=np.uint64) << np.uint64(32))
        yield (keys & np.uint64(0xFFFFFFFF)).astype(np.int64), times, bounds
        first = after


class Sketch:
    """Random projections of BM25 weights, brought to length 1."""

    def __init__(self, idf: np.ndarray, mean_length: float, seed: int = 3):
        self.idf, self.mean_length = idf, mean_length
        self.directions = np.random.default_rng(seed).standard_normal((len(idf), DIMENSIONS), np.float32)

    def of(self, documents: list[np.ndarray]) -> np.ndarray:
        points = [np.zeros((0, DIMENSIONS), np.float32)]
        for terms, times, bounds in distinct(documents):
            held = np.add.reduceat(times, bounds[:-1])
            saturation = times / (times + K1 * (1 - B + B * np.repeat(held, np.diff(bounds)) / self.mean_length))
            weights = (saturation * self.idf[terms]).astype(np.float32)
            spans = zip(bounds[:-1].tolist(), bounds[1:].tolist())
            found = np.array([weights[a:b] @ self.directions[terms[a:b]] for a, b in spans])
            points.append(found / np.maximum(np.linalg.norm(found, axis=1, keepdims=True), 1e-9))
        return np.concatenate(points)


class Index:
    """BM25 postings of the documents of a shard, term by term.

    ``idf`` by term and ``mean_length`` are those of the whole table, or else of these documents. Terms
    that many of the documents hold have a row of single-precision weights instead, one for each document.
    """

    def __init__(self, tokens: list[np.ndarray], idf: np.ndarray | None = None, mean_length: float | None = None):
        found = list(distinct(tokens))
        self.terms = [terms[a:b] for terms, _, bounds in found for a, b in zip(bounds[:-1], bounds[1:])]
        lengths = np.array([len(ids) for ids in tokens], float)
        term = np.concatenate([terms for terms, _, _ in found])
        doc = np.repeat(np.arange(len(tokens)), [len(t) for t in self.terms])
        times = np.concatenate([times for _, times, _ in found]).astype(float)
        order = np.argsort(term, kind="stable")
        self.docs = doc[order]
        self.vocabulary, first, held = np.unique(term[order], return_index=True, return_counts=True)
        self.first, self.after = first, first + held
        idf = inverse_frequency(len(tokens), held) if idf is None else idf[self.vocabulary]
        saturation = times / (times + K1 * (1 - B + B * lengths[doc] / (mean_length or lengths.mean())))
        self.weights = saturation[order] * np.repeat(idf, held)
        self.useful = idf > 0
        self.row_of = np.zeros(int(self.vocabulary.max(initial=0)) + 1, np.int64)
        self.row_of[self.vocabulary] = np.arange(len(self.vocabulary))
        often = np.flatnonzero(self.useful & (held >= OFTEN * len(tokens)))
        self.columns = np.arange(len(tokens))
        self.dense = np.zeros((len(often), len(tokens)), np.float32)
        self.dense_row = np.full(len(self.vocabulary), -1)
        self.dense_row[often] = np.arange(len(often))
        row = np.repeat(self.dense_row, held)
        self.dense[row[row >= 0], self.docs[row >= 0]] = self.weights[row >= 0]
        self._keep(row < 0)

    def _keep(self, kept: np.ndarray) -> None:
        before = np.concatenate(([0], np.cumsum(kept)))
        self.first, self.after = before[self.first], before[self.after]
        self.docs, self.weights = self.docs[kept], self.weights[kept]

    def without(self, unused: np.ndarray) -> None:
        """Leave out the postings of used documents, which are no longer asked for."""
        self._keep(unused[self.docs])
        left = unused[self.columns]
        self.columns, self.dense = self.columns[left], self.dense[:, left]

    def scores(self, seed: int, documents: int) -> np.ndarray:
        """BM25 scores of the documents for the terms of the seed."""
        rows = self.row_of[self.terms[seed]]
        found = self._sparse_scores(rows[self.useful[rows] & (self.after[rows] > self.first[rows])], documents)
        rows = self.dense_row[rows]
        found[self.columns] += self.dense[rows[rows >= 0]].sum(0)
        return found

    def _sparse_scores(self, rows: np.ndarray, documents: int) -> np.ndarray:
        spans = [slice(a, b) for a, b in zip(self.first[rows].tolist(), self.after[rows].tolist())]
        if not spans:
            return np.zeros(documents)
        docs = np.concatenate([self.docs[s] for s in spans])
        return np.bincount(docs, np.concatenate([self.weights[s] for s in spans]), documents)

    def neighbours(self, seed: int, unused: np.ndarray) -> np.ndarray:
        """Unused documents, the best BM25 score for the terms of the seed first."""
        return np.fromiter(self.best_first(seed, unused), np.int64)

    def best_first(self, seed: int, unused: np.ndarray) -> Iterator[int]:
        """The same, sorted as far as they are taken."""
        left = np.flatnonzero(unused)
        scores = -self.scores(seed, len(unused))[left]
        if len(left) > 2 * FIRST_TAKEN:
            best = scores <= np.partition(scores, FIRST_TAKEN)[FIRST_TAKEN]
            yield from left[best][np.argsort(scores[best], kind="stable")].tolist()
            left, scores = left[~best], scores[~best]
        yield from left[np.argsort(scores, kind="stable")].tolist()


def filled(
    tokens: list[np.ndarray], window: int, idf: np.ndarray | None = None, mean_length: float | None = None
) -> list[tuple[int, int, int, int, int]]:
    """Pieces (document, start, length, sequence, offset) of a shard's documents.

    Every sequence is full but those of the shard's tail, which are cut to powers of two, so that
    none needs padding.
    """
    index = Index(tokens, idf, mean_length)
    lengths = np.array([len(ids) for ids in tokens])
    unused, indexed = np.ones(len(tokens), bool), len(tokens)
    left, pieces, sequence, room = int(lengths.sum()), [], 0, 0
    offset, waiting, seed = 0, iter(()), 0

    def following() -> int:
        """The next neighbour of the window, else the next unused document of the shard."""
        nonlocal seed
        for doc in waiting:
            if unused[doc]:
                return doc
        while not unused[seed]:
            seed += 1
        return seed

    doc = start = None
    while left:
        if room == 0:
            room = min(window, 1 << (left.bit_length() - 1)) if left < window else window
            offset, waiting = 0, iter(())
            fresh = True
        if doc is None:
            doc, start = following(), 0
            unused[doc] = False
        length = min(room, int(lengths[doc]) - start)
        pieces.append((doc, start, length, sequence, offset))
        offset, room, left, start = offset + length, room - length, left - length, start + length
        if room and fresh:
            rest = np.count_nonzero(unused)
            if rest < 0.8 * indexed:
                index.without(unused)
                indexed = rest
            waiting, fresh = index.best_first(doc, unused), False
        if start == lengths[doc]:
            doc = None
        if room == 0:
            sequence += 1
    return pieces


def _statistics(stored: DataFrame, kind: str) -> tuple[np.ndarray, float]:
    """BM25's weight by term and the mean length, over all documents."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros(0, np.int64)
        for batch in batches:
            for terms, _, _ in distinct([np.frombuffer(ids, kind) for ids in batch.column("ids").to_pylist()]):
                found = np.bincount(terms)
                more = np.zeros(max(len(found), len(held)), np.int64)
                more[: len(held)] += held
                more[: len(found)] += found
                held = more
        used = np.flatnonzero(held)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(held[used])], names=["term", "held"])

    rows = stored.select("ids").mapInArrow(counted, "term long, held long").groupBy("term").agg(F.sum("held"))
    found = rows.toPandas().to_numpy(np.int64)  # a row for each term of the tokenizer at most
    documents, length = stored.agg(F.count("*"), F.avg(F.octet_length("ids"))).first()
    held = np.zeros(found[:, 0].max(initial=0) + 1, np.int64)
    held[found[:, 0]] = found[:, 1]
    return inverse_frequency(documents, held), (length or 0) / np.dtype(kind).itemsize


def _places(stored: DataFrame, kind: str, sketch, shards: int, shard_bytes: int) -> tuple[Tree, list[tuple[int, int]]]:
    """A tree over sketches, and for each leaf its first shard and its number of shards."""
    documents = stored.count()
    chance = F.pmod(F.xxhash64("doc_id", "ids"), F.lit(1_000_000)) / 1e6
    sample = stored.filter(chance < SAMPLE / documents).select("ids", "size")

    def sketched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            points = sketch.value.of([np.frombuffer(ids, kind) for ids in batch.column("ids").to_pylist()])
            yield pa.RecordBatch.from_arrays(
                [pa.array([p.tobytes() for p in points], pa.binary()), batch.column("size")], names=["point", "size"]
            )

    rows = sample.mapInArrow(sketched, "point binary, size long").toPandas()
    points = np.frombuffer(b"".join(rows["point"]), np.float32).reshape(-1, DIMENSIONS).astype(float)
    tree = Tree(points, LEAVES_A_SHARD * shards, 1 + 1e-6)
    total = stored.agg(F.sum("size")).first()[0]
    sizes = np.bincount(tree.leaf_of(points), rows["size"], tree.leaves) * total / max(rows["size"].sum(), 1)
    places, shard, held = [], 0, 0.0
    for size in sizes.tolist():
        if held and held + size > shard_bytes:
            shard, held = shard + 1, 0.0
        count = max(1, int(-(-size // shard_bytes)))
        places.append((shard, count))
        held += size
        if count > 1:
            shard, held = shard + count, 0.0
    return tree, places


def pack(
    docs: DataFrame,
    window: int = 2048,
    end_id: int = 1,
    shard_bytes: int = 4 << 20,
    tokenizer: str | None = None,
) -> DataFrame:
    """The pieces of all documents, each of which lies in one sequence of at most ``window`` ids.

    ``sequence_id`` holds the shard in its upper 32 bits. A missing or empty text is its end id alone;
    rows with the same id, or none, are packed one by one. Only ``doc_id`` and ``text`` are read.
    """
    file = tokenizer or default_path()
    # A missing id travels as a flag: pandas would turn the other ids of its column into floats.
    known = docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(0)).alias("doc_id"),
        F.col("doc_id").isNotNull().alias("__named"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    kind = "<u2" if max(vocabulary_size(file), end_id + 1) <= 1 << 16 else "<u4"

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, end = word_tokenizer(file), np.array([end_id], kind).tobytes()
        for batch in batches:
            ids = [
                np.frombuffer(found, "<u4").astype(kind).tobytes() + end
                for found in encoder.ids_of(batch.column("text").to_pylist())
            ]
            columns = [batch.column("doc_id"), batch.column("__named"), batch.column("size"), pa.array(ids, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "__named", "size", "ids"])

    sized = known.withColumn("size", F.octet_length("text").cast("long") + 64)
    stored = written(sized.mapInArrow(encoded, "doc_id long, __named boolean, size long, ids binary"), "packing-ids")
    total = stored.agg(F.sum("size")).first()[0] or 0
    shards = total // shard_bytes + 1
    idf, mean_length = _statistics(stored, kind)
    context = docs.sparkSession.sparkContext
    weights = context.broadcast(idf)
    if shards > 1:
        sketch = context.broadcast(Sketch(idf, mean_length))
        placing = context.broadcast(_places(stored, kind, sketch, shards, shard_bytes))

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree, places = placing.value
        for batch in batches:
            found = batch.column("ids").to_pylist()
            points = sketch.value.of([np.frombuffer(ids, kind) for ids in found]).astype(float)
            leaves = tree.leaf_of(points).tolist()
            shard = [
                places[leaf][0] + (zlib.crc32(ids, doc_id & 0xFFFFFFFF) % places[leaf][1])
                for leaf, ids, doc_id in zip(leaves, found, batch.column("doc_id").to_pylist())
            ]
            columns = [batch.column(c) for c in ("doc_id", "__named", "ids")] + [pa.array(shard, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "__named", "ids", "__shard"])

    def packed(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["__named", "doc_id", "ids"], ignore_index=True)
        tokens = [np.frombuffer(ids, kind).astype("<u4") for ids in frame["ids"]]
        shard = int(frame["__shard"].iloc[0])
        found = pd.DataFrame(
            filled(tokens, window, weights.value, mean_length),
            columns=["row", "start", "length", "sequence_id", "offset"],
        )
        found["ids_crc32"] = [
            zlib.crc32(tokens[r][s : s + n]) for r, s, n in zip(found["row"], found["start"], found["length"])
        ]
        found["doc_tokens"] = np.array([len(ids) for ids in tokens])[found["row"]]
        found["doc_id"] = frame["doc_id"].astype("Int64").where(frame["__named"]).array[found["row"]]
        found["sequence_id"] += shard << 32
        return found[[c.split(" ")[0] for c in PIECE.split(", ")]]

    rows = (
        stored.select("doc_id", "__named", "ids").mapInArrow(
            placed, "doc_id long, __named boolean, ids binary, __shard long"
        )
        if shards > 1
        else stored.select("doc_id", "__named", "ids", F.lit(0).cast("long").alias("__shard"))
    )
    return rows.groupBy("__shard").applyInPandas(packed, PIECE)
