from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from lakeops.llm import negatives
from lakeops.llm.queries import QUERIES

SCHEMA = "vec_id long, label int, embedding array<double>, part int, width string, angles int"


def table(spark, rows):
    return spark.createDataFrame([(i, label, v, 1, "w", 2) for i, label, v in rows], SCHEMA)


def brute(rows, is_anchor, n_positives=5, n_negatives=10, window=(30, 90)):
    usable = {}
    for i, label, vector in rows:
        if i is None or label is None or vector is None or not all(x is not None and math.isfinite(x) for x in vector):
            continue
        row = (label, [math.floor(256 * x) for x in vector])
        if sum(x * x for x in row[1]) < 2**62:
            usable[i] = min(row, usable.get(i, row))
    found = set()
    for anchor, (label, vector) in usable.items():
        if not is_anchor(anchor):
            continue
        scored = sorted(
            (-sum(a * b for a, b in zip(vector, v)), i, other)
            for i, (other, v) in usable.items()
            if i != anchor and len(v) == len(vector)
        )
        for score, positive, _ in [s for s in scored if s[2] == label][:n_positives]:
            fits = [
                s for s in scored if s[2] != label and window[0] * -score <= 100 * -s[0] <= window[1] * -score
            ]
            found |= {(anchor, positive, rank + 1, i, -score, -s) for rank, (s, i, _) in enumerate(fits[:n_negatives])}
    return found


def rows_of(result):
    return {tuple(r) for r in result.collect()}


def generated():
    random = np.random.default_rng(3)
    rows = []
    for i in range(900):
        centre = np.eye(12)[i % 5] * 2
        rows.append((i, int(i * 7 % 6), (centre + random.normal(0, 0.4, 12)).tolist()))
    same = rows[3][2]
    rows += [(2_000 + i, i % 2, same) for i in range(60)]  # ties
    rows += [(3_000 + i, i % 3, [0.0] * 12) for i in range(20)]
    rows += [(4_000 + i, i % 2, [float(i % 3), 1.0, 2.0]) for i in range(40)]  # another width
    rows += [(5_000 + i, 1, []) for i in range(3)]
    rows += [(None, 1, same), (6_000, None, same), (6_001, 1, None), (6_002, 1, [None] * 12), (6_003, 1, [math.nan] * 12)]
    rows += [(6_004, 1, [math.inf] * 12), (6_005, 1, [1e30] * 12), (6_006, 2, [1e-30] * 12)]
    rows += [(0, 4, same), (0, 4, same), (30, 3, rows[30][2])]  # repeated ids
    return rows


@pytest.mark.parametrize("block, anchors", [(512, 2_048), (40, 7)])
def test_agrees_with_all_pairs(spark, monkeypatch, block, anchors):
    monkeypatch.setattr(negatives, "LEAST_BLOCK", block)
    monkeypatch.setattr(negatives, "WANTED_BLOCKS", 10_000)
    monkeypatch.setattr(negatives, "ANCHOR_BLOCK", anchors)
    rows = generated()
    got = rows_of(negatives.hard_negatives(table(spark, rows), F.col("vec_id") % 10 == 0))
    assert got == brute(rows, lambda i: i % 10 == 0) and len(got) > 1_000


def test_large_components_are_scored_exactly(spark):
    random = np.random.default_rng(5)
    rows = [(i, i % 2, (random.normal(0, 1, 3) * 2.0**20).tolist()) for i in range(120)]
    got = rows_of(negatives.hard_negatives(table(spark, rows), F.col("vec_id") % 10 == 0))
    assert got == brute(rows, lambda i: i % 10 == 0) and got


def test_bounds_hold_the_scores():
    random = np.random.default_rng(7)
    rows = np.floor(256 * random.normal(0, 1, (300, 20)) * random.uniform(0, 3, (300, 1)))
    rows[5:9] = rows[4] * 2
    rows[9] = 0
    known = negatives.reference_directions(rows[:100], 6)
    angles, norms = negatives.angles_to(known, rows), np.sqrt((rows**2).sum(axis=1))
    lower, upper = negatives.score_bounds(norms, angles, norms, angles)
    exact = rows @ rows.T
    assert (lower <= exact).all() and (exact <= upper).all()
    # They say more than the norms do.
    assert (upper - lower).mean() < 1.9 * np.outer(norms, norms).mean()


def test_few_rows(spark):
    assert rows_of(negatives.hard_negatives(table(spark, []), F.col("vec_id") % 100 == 0)) == set()
    lonely = [(0, 1, [1.0, 2.0]), (1, 2, [1.0, 1.0])]
    assert rows_of(negatives.hard_negatives(table(spark, lonely), F.col("vec_id") == 0)) == set()
    few = [(0, 1, [1.0]), (1, 1, [1.0]), (2, 2, [0.5]), (3, 2, [0.95]), (4, 3, [0.5])]
    got = rows_of(negatives.hard_negatives(table(spark, few), F.col("vec_id") == 0))
    assert got == {(0, 1, 1, 2, 65_536, 32_768), (0, 1, 2, 4, 65_536, 32_768)}


def test_query(spark):
    folder = "/root/testdata/sf0.001"
    rows = []
    for r in spark.read.parquet(f"{folder}/embeddings.parquet").collect():
        label = (r["label"] + 1) % 10 if r["vec_id"] % 7 == 0 else r["label"]
        rows.append((r["vec_id"], label, r["embedding"]))
    assert rows_of(QUERIES["op13_hard_negatives"](spark, folder)) == brute(rows, lambda i: i % 100 == 0)
