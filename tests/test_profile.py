from __future__ import annotations

import itertools
import random

import pytest
from pyspark.sql import functions as F

from lakeops.operators import profile


def brute_keys(rows, names, most):
    found = []
    for size in range(1, most + 1):
        for s in itertools.combinations(range(len(names)), size):
            values = [tuple(r[i] for i in s) for r in rows]
            if rows and all(v is not None for t in values for v in t) and len(set(values)) == len(rows):
                if not any(set(k) <= set(s) for k in found):
                    found.append(s)
    return sorted((",".join(names[i] for i in s), len(s)) for s in found)


@pytest.mark.parametrize("seed", range(3))
def test_key_candidates_agree_with_all_sets(spark, rows, seed):
    chance = random.Random(seed)
    names = ["a", "b", "c d", "e", "f"]
    table = [
        (i // 10, i % 10, chance.randrange(12), None if i == 5 else i, chance.randrange(3)) for i in range(60 + seed * 20)
    ]
    frame = spark.createDataFrame(table, "a int, b int, `c d` int, e int, f int")
    assert rows(profile.key_candidates(frame, most_columns=3)) == brute_keys(table, names, 3)


def test_key_candidates_of_odd_tables(spark, rows):
    frame = spark.createDataFrame([(1, "x", None)], "a int, b string, c int")
    assert rows(profile.key_candidates(frame)) == [("a", 1), ("b", 1)]
    assert rows(profile.key_candidates(frame.limit(0))) == []
    twice = frame.union(frame)
    assert rows(profile.key_candidates(twice)) == []
    assert rows(profile.key_candidates(frame, ["b"])) == [("b", 1)]


def test_growing_profile_reads_new_rows_only(spark, path, rows):
    growing = profile.GrowingProfile(spark, path)
    frame = spark.range(30_000).select(
        "id", (F.col("id") % 100).cast("double").alias("v"), F.when(F.col("id") % 2 == 0, "x").alias("t")
    )
    frame = frame.withColumn("v", F.when(F.col("id") == 7, F.lit(float("nan"))).otherwise(F.col("v")))
    for commit in range(3):
        growing.add(frame.where(F.col("id") % 3 == commit), commit)
    growing.add(frame.where(F.col("id") % 3 == 0), 0)
    assert growing.commits() == [0, 1, 2]
    found = {r["column_name"]: r for r in growing.profile([0.0, 0.5, 1.0]).collect()}
    full = {r["column_name"]: r for r in profile.profile_columns(frame).collect()}
    for name, r in found.items():
        for c in ("row_count", "null_count", "nan_count", "min_number", "max_number"):
            assert r[c] == full[name][c]
        assert abs(r["distinct_count"] - full[name]["distinct_count"]) <= profile.DISTINCT_BOUND * full[name]["distinct_count"]
    assert abs(found["id"]["quantiles"][1] - 15_000) < 600 and found["t"]["quantiles"] is None
    assert found["v"]["quantiles"][0] == 0.0 and found["v"]["quantiles"][2] == 99.0


def test_growing_profile_of_rows_without_values(spark, path):
    growing = profile.GrowingProfile(spark, path)
    empty = spark.createDataFrame([], "a int, b string")
    growing.add(empty, 0)
    growing.add(spark.createDataFrame([(None, None)], "a int, b string"), 1)
    found = {r["column_name"]: r for r in growing.profile().collect()}
    assert found["a"]["row_count"] == 1 and found["a"]["null_count"] == 1 and found["a"]["distinct_count"] == 0
    assert found["a"]["quantiles"] is None
