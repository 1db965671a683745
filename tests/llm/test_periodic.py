from __future__ import annotations

import hashlib
import random
import time
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from lakeops.llm import periodic
from lakeops.llm.queries import QUERIES

from .conftest import sentence


def brute_runs(words):
    """(start, length, period) of all runs, by every period."""
    n, found = len(words), {}
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            start = i
            while i + q < n and words[i] == words[i + q]:
                i += 1
            if i + q - start >= max(6, 4 * q):
                found.setdefault((start, i + q - start), q)
            i += i == start
    return sorted((s, q, length) for (s, length), q in found.items())


def brute(doc_id, text):
    words = [w for w in (text or "").translate(periodic._TO_SPACE).split(" ") if w]
    n, h = len(words), zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = brute_runs(words)
    kept = [w for i, w in enumerate(words) if not any(s + q <= i < s + length for s, q, length in runs)]
    top = min(runs, key=lambda r: (-r[2] / r[1], r[0], r[1])) if runs else None
    sha = lambda t: hashlib.sha256(t.encode("utf-8", "surrogatepass")).hexdigest()
    return (
        doc_id,
        len(runs),
        *((top[0], top[2], top[1], 1000 * top[2] // top[1]) if top else (None,) * 4),
        sha("".join(f"{s},{length},{q}\n" for s, q, length in runs)),
        sha(" ".join(kept)),
    )


def generated(seed):
    chance = random.Random(seed)
    letters, words = "abcdefgh"[: chance.choice([1, 2, 2, 3, 5])], []
    for _ in range(chance.randint(0, 4)):
        words += chance.choices(letters, k=chance.randint(0, 12))
        unit = chance.choices(letters, k=chance.randint(1, 14))
        words += (unit * 9)[: chance.randint(0, 9 * len(unit))]
    return chance.choice([" ", "\n", " \t"]).join(words)


def key(row):
    return tuple((x is None, x) for x in row)


def test_agrees_with_every_period(spark, documents, odd_rows):
    rows = odd_rows + [(100 + i, generated(i)) for i in range(500)]
    rows += [(5_000 + i, f"{sentence(i, i)} {sentence(i + 1, 7)}") for i in range(60)]
    rows += [(9_000, "a " * 9_999), (9_001, " ".join(map(str, range(701))) * 5), (100, generated(0)), (100, generated(1))]
    got = [tuple(r) for r in periodic.collapse_runs(documents(rows)).collect()]
    assert sorted(got, key=key) == sorted((brute(*r) for r in rows), key=key)


@pytest.mark.parametrize("tile, batch", [(8, 500_000), (64, 40)])
def test_tiles_do_not_change_runs(monkeypatch, tile, batch):
    """Runs cut by many tiles are found in pieces that meet."""
    monkeypatch.setattr(periodic, "TILE_WORDS", tile)
    texts = [generated(i).split() for i in range(2_000)]
    known = {}
    ids = [np.array([known.setdefault(w, len(known)) for w in words], np.int64) for words in texts]
    pieces = {}
    for row, period, start, end in periodic.fragments(np.concatenate(ids), np.cumsum([0, *map(len, ids)])):
        pieces.setdefault((row, period), []).append([start, end])
    found = [[] for _ in texts]
    for (row, period), spans in pieces.items():
        joined = []
        for start, end in sorted(spans):
            if joined and start <= joined[-1][1]:
                joined[-1][1] = max(end, joined[-1][1])
            else:
                joined.append([start, end])
        found[row] += [(s, period, e + period - s) for s, e in joined if e + period - s >= max(6, 4 * period)]
    assert [sorted(f) for f in found] == [brute_runs(words) for words in texts]


def test_stitching_joins_what_touches(spark):
    rows = [(1, 7, 2, 0, 5), (1, 7, 2, 5, 9), (1, 7, 2, 10, 12), (1, 7, 3, 4, 20), (None, 7, 1, 0, 5), (None, 7, 1, 0, 5)]
    pieces = spark.createDataFrame(rows, "doc_id long, row long, period long, start long, end long")
    got = {tuple(r) for r in periodic.stitched(pieces).collect()}
    assert got == {(1, 7, 0, 11, 2), (1, 7, 4, 19, 3), (None, 7, 0, 6, 1)}


def test_empty_table(spark, documents):
    result = periodic.collapse_runs(documents([]))
    assert result.collect() == []
    assert result.columns[:2] == ["doc_id", "n_runs"]


@pytest.mark.parametrize("words", [["a"] * 200_000, list(map(str, range(1_000))) * 200, random.Random(1).choices("ab", k=200_000)])
def test_long_documents_take_seconds(words):
    known = {}
    ids = np.array([known.setdefault(w, len(known)) for w in words], np.int64)
    began = time.time()
    periodic.fragments(ids, np.array([0, len(ids)]))
    assert time.time() - began < 20


def test_query(spark):
    folder = "/root/testdata/sf0.001"
    rows = spark.read.parquet(f"{folder}/documents.parquet").filter(F.length("text") < 6_000).select("doc_id", "text").collect()
    got = {r["doc_id"]: tuple(r) for r in QUERIES["op12_periodic_runs"](spark, folder).collect()}
    assert len(rows) > 100 and sum(r[1] > 0 for r in got.values()) > 5
    for doc_id, text in rows:
        assert got[doc_id] == brute(doc_id, text)
