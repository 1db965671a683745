from __future__ import annotations

import math
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from lakeops.llm import ann, hmm, quality
from lakeops.llm.common import plain_words

from .conftest import sentence

VECTORS = "vec_id long, embedding array<float>, leaf string, rank int"


def vectors_table(spark, rows):
    return spark.createDataFrame([(i, v, "x", 0) for i, v in rows], VECTORS)


def exact(rows, query_id, query, k):
    good = [
        (i, np.array(v, np.float32).astype(float))
        for i, v in rows
        if i is not None and v and None not in v and np.all(np.isfinite(v)) and any(v) and len(v) == len(query)
    ]
    scored = sorted((-float((v * query).sum()), i) for i, v in good if i != query_id)
    return [(i, -s) for s, i in scored[:k]]


def test_search_of_few_rows_is_exact(spark):
    rows = [(i, [float(i % 5), 1.0, -float(i)]) for i in range(30)]
    rows += [(40, None), (41, []), (42, [0.0] * 3), (43, [1.0, None, 2.0]), (44, [math.nan, 1.0, 1.0])]
    rows += [(45, [math.inf, 0.0, 0.0]), (60, [1.0, 2.0]), (None, [1.0, 1.0, 1.0]), (61, [0.0, 1.0, 0.0]), (62, [0.0, 1.0, 0.0])]
    found = ann.search(vectors_table(spark, rows), F.col("vec_id") % 20 == 0, k=7)
    for query in (0, 20):
        got = [(r.vec_id, r.score) for r in found.filter(F.col("query_id") == query).orderBy("rank").collect()]
        assert got == exact(rows, query, np.array(dict(rows)[query], float), 7)
    assert {r.query_id for r in found.collect()} == {0, 20}
    assert found.filter("query_id = 0").agg(F.max("rank")).first()[0] == 7
    assert ann.search(vectors_table(spark, []), F.col("vec_id") % 20 == 0).count() == 0
    two = vectors_table(spark, [(0, [1.0, 2.0]), (3, [3.0, 1.0])])
    assert [tuple(r)[:3] for r in ann.search(two, F.col("vec_id") == 0).collect()] == [(0, 1, 3)]


def test_search_through_a_tree_reaches_its_recall(spark, monkeypatch):
    monkeypatch.setattr(ann, "LEAF_ROWS", 40)
    monkeypatch.setattr(ann, "BLOCK_ROWS", 64)
    random = np.random.default_rng(1)
    points = random.normal(size=(3_000, 12)) * random.uniform(0.2, 3, (3_000, 1))
    points[1_000:2_000] = points[999] + 1e-3 * random.normal(size=(1_000, 12))  # one crowded leaf
    rows = [(i, v) for i, v in enumerate(points.astype(np.float32).astype(float).tolist())]
    found = ann.search(vectors_table(spark, rows), F.col("vec_id") % 20 == 0, k=10).collect()
    assert len(found) == 150 * 10
    right = 0
    for query in range(0, 3_000, 20):
        expected = dict(exact(rows, query, np.array(rows[query][1]), 10))
        own = [r for r in found if r.query_id == query]
        right += sum(r.vec_id in expected for r in own)
        assert all(r.score == pytest.approx(float(np.dot(rows[query][1], rows[r.vec_id][1]))) for r in own)
    assert right >= 0.9 * 1_500


def test_equal_vectors_are_ordered_by_id(spark):
    rows = [(i, [0.1, 0.7, 0.3, 0.9]) for i in range(500)]
    found = ann.search(vectors_table(spark, rows), F.col("vec_id") == 100, k=20).orderBy("rank").collect()
    assert [r.vec_id for r in found] == list(range(20)) and len({r.score for r in found}) == 1


def test_copies_of_one_vector_get_all_their_neighbours(spark):
    random = np.random.default_rng(2)
    centres = random.normal(size=(200, 16))
    centres /= np.linalg.norm(centres, axis=1, keepdims=True)
    points = np.repeat(centres, 300, 0) + 0.02 * random.normal(size=(60_000, 16))
    points /= np.linalg.norm(points, axis=1, keepdims=True)
    points[:2_000] = np.full(16, 0.25)
    rows = [(i, v) for i, v in enumerate(points.tolist())]
    found = ann.search(vectors_table(spark, rows), F.col("vec_id") % 500 == 0, k=20).collect()
    for query in range(0, 2_000, 500):
        own = sorted((r.rank, r.vec_id) for r in found if r.query_id == query)
        assert [i for _, i in own] == [i for i in range(21) if i != query][:20]
    assert len(found) == 120 * 20


def test_search_goes_on_until_leaves_hold_enough_rows():
    tree = ann.Tree(np.repeat(np.eye(4), 50, 0), 16, 1.0)
    sizes = np.zeros(tree.leaves, int)
    full = tree.leaf_of(np.eye(4))
    sizes[full] = 15
    first = tree.visited(np.eye(4)[2], 1, sizes)
    assert first == [full[2]]
    assert len(tree.visited(np.eye(4)[2], 1, sizes, 16)) == 2 and set(tree.visited(np.eye(4)[2], 99, sizes)) == set(full)


def labelled(spark, count=400):
    docs = [(i, sentence(i, 30 + i % 50) if i % 4 else " | ".join([sentence(i, 1)] * 40)) for i in range(count)]
    labels = spark.createDataFrame([(i, int(i % 4 > 0), 0) for i in range(count)], "doc_id long, quality int, toxic int")
    return docs, labels


def test_quality_is_learned_and_held_out_rows_agree(spark, documents, odd_rows):
    docs, labels = labelled(spark)
    rows = docs + [(i if i is None else 1_000 + i, t) for i, t in odd_rows]
    found = quality.score_documents(documents(rows), labels).collect()
    assert len(found) == len(rows)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in found)
    for r in found:
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 3 == 1)
    held = [r for r in found if r.held_out and r.doc_id < 400]
    assert sum(r.predicted == int(r.doc_id % 4 > 0) for r in held) >= 0.95 * len(held)
    good = quality.good_documents(documents(docs), labels)
    assert good.columns == ["doc_id", "text", "block", "key"]
    assert abs(good.count() - 300) <= 15


def test_held_out_labels_change_nothing(spark, documents):
    docs, labels = labelled(spark, 200)
    other = labels.withColumn("quality", F.when(quality.held_out(), 1 - F.col("quality")).otherwise(F.col("quality")))
    first = quality.score_documents(documents(docs), labels).orderBy("doc_id").collect()
    second = quality.score_documents(documents(docs), other).orderBy("doc_id").collect()
    assert [r.score for r in first] == pytest.approx([r.score for r in second], abs=1e-9)


def test_quality_without_labels_or_documents(spark, documents, odd_rows):
    _, labels = labelled(spark, 10)
    none = labels.filter("doc_id < 0")
    assert {r.score for r in quality.score_documents(documents(odd_rows), none).collect()} <= {0.4995}
    assert quality.score_documents(documents([]), labels).count() == 0
    ones = spark.createDataFrame([(i, 1, 0) for i in range(20)], "doc_id long, quality int, toxic int")
    docs = documents([(i, sentence(i, 20)) for i in range(20)])
    assert all(r.predicted == 1 for r in quality.score_documents(docs, ones).collect())


def brute_forward(model, symbols):
    state, total = model.start * model.emits[:, symbols[0]], 1.0
    for s in symbols[1:]:
        state = (state @ model.moves) * model.emits[:, s]
    return math.log10(state.sum() * total)


def small_model(states=3, width=7, seed=0):
    random = np.random.default_rng(seed)
    return hmm.Model(random.dirichlet(np.ones(states)), random.dirichlet(np.ones(states), states), random.dirichlet(np.ones(width), states))


def test_forward_is_exact():
    model, random = small_model(), np.random.default_rng(2)
    sequences = [random.integers(0, 7, n) for n in (1, 5, 5, 40, 2, 90, 1)]
    assert hmm.forward_log10(model, sequences) == pytest.approx([brute_forward(model, s) for s in sequences])


def test_expected_counts_are_those_of_all_paths():
    from itertools import product

    model = small_model()
    sequences = [np.array(s) for s in ([0, 3, 6, 3], [2], [5, 5, 1])]
    starts, moves, emits = np.zeros(3), np.zeros((3, 3)), np.zeros((3, 7))
    hmm.expected_counts(model, sequences, starts, moves, emits)
    a, b, c = np.zeros(3), np.zeros((3, 3)), np.zeros((3, 7))
    for s in sequences:
        paths = {}
        for path in product(range(3), repeat=len(s)):
            p = model.start[path[0]] * model.emits[path[0], s[0]]
            for t in range(1, len(s)):
                p *= model.moves[path[t - 1], path[t]] * model.emits[path[t], s[t]]
            paths[path] = p
        total = sum(paths.values())
        for path, p in paths.items():
            a[path[0]] += p / total
            for t, state in enumerate(path):
                c[state, s[t]] += p / total
                if t:
                    b[path[t - 1], state] += p / total
    assert starts == pytest.approx(a) and moves == pytest.approx(b) and emits == pytest.approx(c)


def test_scores_of_documents(spark, documents, odd_rows, monkeypatch):
    monkeypatch.setattr(hmm, "COUNTED", 60)
    monkeypatch.setattr(hmm, "SYMBOLS", 40)
    rows = odd_rows + [(100 + i, " ".join(sentence(i % 7, 30).split()[::-1]) + f" word{i}") for i in range(60)]
    found = hmm.score_documents(documents(rows), states=3, iterations=3).collect()
    tokens = lambda t: [*plain_words(t), "\n"]
    held = lambda i: i is not None and zlib.crc32(str(i).encode()) % 7 == 2
    counts = Counter(w for i, t in rows if not held(i) for w in tokens(t))
    n, v = sum(counts.values()), len(counts)
    expected = sorted(
        (str(i), held(i), len(tokens(t)), sum(counts[w] > 0 for w in tokens(t)), n,
         round(sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in tokens(t)), 6))
        for i, t in rows
    )
    got = sorted((str(r[0]), r[1], r[2], r[3], r[4], round(r[5], 6)) for r in found)
    assert got == expected
    assert all(r.score < 0 and math.isfinite(r.score) for r in found)
    own = [r for r in found if not r.held_out]
    assert sum(r.score for r in own) > sum(r.base_score for r in own)
    assert hmm.score_documents(documents([])).count() == 0


def test_training_raises_the_likelihood():
    random = np.random.default_rng(4)
    sequences = [random.integers(0, 5, 50) + 5 * (i % 2) for i in range(40)]
    unigram = np.full(10, 0.1)
    model, before = hmm.Model.initial(unigram, 2), -np.inf
    for _ in range(6):
        now = hmm.forward_log10(model, sequences).sum()
        assert now >= before - 1e-6
        before = now
        sums = np.zeros(2), np.zeros((2, 2)), np.zeros((2, 10))
        hmm.expected_counts(model, sequences, *sums)
        model = hmm.Model.estimated(*sums, unigram)
    assert hmm.forward_log10(model, sequences).sum() > -40 * 50 * 0.85


def pooled(values, labels, weights):
    """Isotonic regression by pooling neighbours that violate the order."""
    blocks = []
    for v, label, w in sorted(zip(values, labels, weights)):
        blocks.append([label * w, w, [v]])
        while len(blocks) > 1 and blocks[-2][0] / blocks[-2][1] >= blocks[-1][0] / blocks[-1][1]:
            total, weight, held = blocks.pop()
            blocks[-1] = [blocks[-1][0] + total, blocks[-1][1] + weight, blocks[-1][2] + held]
    return [v for b in blocks for v in b[2]], [b[0] / b[1] for b in blocks for _ in b[2]]


def test_quality_agrees_with_least_squares_and_pooling(spark, documents):
    """The whole operator again on one machine: least squares instead of normal equations."""
    rows = [(i, sentence(i, 5 + i % 90) + ("\n###!!" * (i % 7) if i % 3 == 0 else ".")) for i in range(400)]
    quality_of = {i: int(i % 3 > 0 or i % 11 == 0) for i, _ in rows[:330]}
    labels = spark.createDataFrame([(i, q, 0) for i, q in quality_of.items()], "doc_id long, quality int, toxic int")
    got = {r.doc_id: r.score for r in quality.score_documents(documents(rows), labels).collect()}

    crc = lambda i: zlib.crc32(str(i).encode())
    stats = {i: quality.statistics(t) for i, t in rows}
    known = [i for i in quality_of if crc(i) % 3 != 1]
    calibrating = [i for i in known if crc(i) // 3 % 4 == 0]
    fitting = [i for i in known if i not in set(calibrating)]
    every = np.array([stats[i] for i in known])
    model = quality.Scorer(every.mean(0), np.maximum(every.std(0), 1e-3), None, None, None)
    features = model.features(np.array([stats[i] for i in fitting]))
    penalty = np.sqrt(quality.RIDGE * len(fitting)) * np.eye(features.shape[1])
    penalty[-1, -1] = np.sqrt(1e-9)
    wanted = np.concatenate(([quality_of[i] for i in fitting], np.zeros(len(penalty))))
    model.weights = np.linalg.lstsq(np.vstack((features, penalty)), wanted, rcond=None)[0]
    raw = np.clip(model.raw(np.array([stats[i] for i in calibrating])), -1, 2)
    bins = {}
    for place, i in zip(np.round((raw + 1) / 3 * quality.BINS) / quality.BINS * 3 - 1, calibrating):
        bins.setdefault(float(place), []).append(quality_of[i])
    share = sum(quality_of[i] for i in known) / len(known)
    places = [-1.0, 2.0, *bins]
    averages = [share, share, *(sum(b) / len(b) for b in bins.values())]
    model.edges, model.levels = map(np.array, pooled(places, averages, [1, 1, *map(len, bins.values())]))
    expected = model.scores(np.array([stats[i] for i, _ in rows]))
    assert [got[i] for i, _ in rows] == pytest.approx(expected.tolist(), abs=1e-6)


def test_fourier_features_approximate_the_gaussian_kernel():
    random = np.random.default_rng(9)
    rows = random.normal(0, 1, (60, quality.N_STATISTICS))
    flat = np.zeros(quality.N_STATISTICS)
    features = quality.Scorer(flat, flat + 1, None, None, None).features(rows)[:, :-1]
    kernel = np.exp(-((rows[:, None] - rows[None]) ** 2).sum(2) / (2 * quality.WIDTH**2))
    assert np.abs(features @ features.T - kernel).mean() < 2 / np.sqrt(quality.FEATURES)


def test_good_documents_learn_from_a_bounded_sample(spark, documents):
    rows = [(i, sentence(i, 40) if i % 4 else "### " * 30) for i in range(300)] + [(None, None), (7, ""), (7, "")]
    labels = spark.createDataFrame([(i, int(i % 4 > 0), 0) for i in range(300)], "doc_id long, quality int, toxic int")
    kept = quality.good_documents(documents(rows), labels, most_labelled=120)
    assert kept.columns == ["doc_id", "text", "block", "key"]
    assert {r.doc_id for r in kept.collect() if r.text and len(r.text) > 5} == {i for i in range(300) if i % 4}
