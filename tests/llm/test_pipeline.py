from __future__ import annotations

import time
from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
import __spark_entry__ as registry
from lakeops.llm import decontam, lines, ngram_join
from lakeops.llm.queries import QUERIES, SQL

from .conftest import sentence
from .test_dedup import brute_components, brute_lines, lowered, split_words, varied
from .test_tokens import check_packing

FOLDER = "/root/testdata/sf0.001"
ITEMS = "item_id long, text string, size int"


def item_table(spark, rows):
    return spark.createDataFrame([(i, t, 1) for i, t in rows], ITEMS)


def counted(words):
    return Counter(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))) if words else Counter()


def brute_leaks(rows, items, least=0.8):
    found = set()
    for i, text in rows:
        words = split_words((text or "").lower())
        for item, passage in items:
            wanted = split_words((passage or "").lower())
            if not wanted or not words:
                continue
            for start in range(max(1, len(words) - len(wanted) + 1)):
                window = counted(words[start : start + len(wanted)])
                both, either = window & counted(wanted), window | counted(wanted)
                if sum(both.values()) >= least * sum(either.values()):
                    found.add((i, item))
    return found


def planted():
    items = [(n, sentence(500 + n, 15 + 4 * n)) for n in range(10)]
    items += [(20, None), (21, ""), (22, "two words"), (23, items[3][1]), (24, "la " * 20)]
    rows = []
    for i in range(40):
        words = items[i % 10][1].split(" ")
        if i % 3 == 1:
            words[len(words) // 2] = "changed"
        if i % 3 == 2:
            words[:4] = []
        passage = " ".join(words).upper() if i % 5 == 0 else "\n".join([" ".join(words[:7]), " ".join(words[7:])])
        rows.append((i, f"{sentence(i, 40)} {passage}\t{sentence(i + 99, 20)}" if i % 4 else passage))
    rows += [(50, "two words"), (51, "Two\tWords"), (52, "not two words"), (53, "la " * 60), (7, rows[7][1]), (None, rows[9][1])]
    return rows, items


def test_leaks_agree_with_all_windows(spark, documents, odd_rows):
    rows, items = planted()
    rows += odd_rows
    found = decontam.leaks(documents(rows), item_table(spark, items)).collect()
    assert {(r.doc_id, r.item_id) for r in found} == brute_leaks(rows, items)
    assert all(0.8 <= r.similarity <= 1 for r in found)
    assert decontam.leaks(documents([]), item_table(spark, items)).count() == 0
    assert decontam.leaks(documents(rows), item_table(spark, [])).count() == 0


def test_leaks_damaged_at_both_ends_and_in_the_middle(spark, documents):
    items = [(n, sentence(700 + n, 59)) for n in range(3)] + [(9, sentence(709, 120))]
    rows = []
    for i, (_, text) in enumerate(items * 6):
        words = text.split(" ")
        words[: 1 + i // 8] = ["changed"] * (1 + i // 8)
        words[-1] = "changed"
        middle = len(words) // 2
        words[middle : middle + (i // 4 % 2)] = ["two", "more"]
        rows.append((i, " ".join([sentence(i, i % 3 * 20), *words, sentence(i + 99, i % 2 * 20)])))
    rows.append((90, " ".join([*["changed"], *items[0][1].split(" ")[1:29], "two", "more", *items[0][1].split(" ")[29:58], "changed"])))
    found = decontam.leaks(documents(rows), item_table(spark, items)).collect()
    assert {(r.doc_id, r.item_id) for r in found} == brute_leaks(rows, items)
    assert (90, 0) in {(r.doc_id, r.item_id) for r in found}
    assert [r.position for r in found if r.doc_id == 90] == [1]


@pytest.mark.parametrize("words", [5_000, 100_000])
def test_text_that_repeats_an_item_takes_time_in_proportion(spark, documents, words):
    items = [(1, sentence(800, 100)), (2, "la " * 20), (3, sentence(801, 3))]
    rows = [(n, " ".join((text.split(" ") * words)[:words])) for n, text in items]
    began = time.time()
    found = decontam.leaks(documents(rows), item_table(spark, items)).collect()
    assert time.time() - began < 90
    assert {(r.doc_id, r.item_id, r.position) for r in found} == {(1, 1, 0), (2, 2, 0), (3, 3, 0)}


def test_repeated_item_agrees_with_all_windows(spark, documents):
    items = [(1, sentence(800, 30)), (2, "la " * 12), (3, sentence(801, 3))]
    rows = [(n, (text + " " + sentence(n, n)) * 12) for n, text in items]
    rows += [(10 + n, " ".join(varied(text, 1 + n % 3, n) for _ in range(6))) for n, text in items * 2]
    found = decontam.leaks(documents(rows), item_table(spark, items)).collect()
    assert {(r.doc_id, r.item_id) for r in found} == brute_leaks(rows, items)


def test_items_that_share_an_id_or_have_none(spark, documents):
    one, other = sentence(810, 40), sentence(811, 25)
    rows = [(1, one), (2, other), (3, f"{other} {one}"), (4, sentence(812, 30))]
    found = decontam.leaks(documents(rows), item_table(spark, [(5, one), (5, other), (5, one), (None, sentence(812, 30))]))
    assert sorted((r.doc_id, r.item_id) for r in found.collect()) == [(1, 5), (2, 5), (3, 5)]


def test_index_joins_few_rows_for_many_items_of_one_size(spark, documents):
    """Windows are compared with the items that their shingles name, not with all items of their size."""
    items = [(n, sentence(10_000 + n, 30)) for n in range(2_000)]
    rows = [(n, f"{sentence(n, 20)} {items[n * 7][1]}") for n in range(200)]
    found = decontam.leaks(documents(rows), item_table(spark, items))
    plan = found._jdf.queryExecution().executedPlan()
    assert sorted((r.doc_id, r.item_id) for r in found.collect()) == [(n, n * 7) for n in range(200)]
    assert "Cartesian" not in plan.toString() and "NestedLoop" not in plan.toString()


def test_blocks_find_all_within_the_radius(spark):
    chance = __import__("random").Random(6)
    pairs = []
    for _ in range(200):
        one = chance.getrandbits(64)
        other = one
        for bit in chance.sample(range(64), decontam.RADIUS):
            other ^= 1 << bit
        pairs.append(tuple(x - (1 << 64) if x >> 63 else x for x in (one, other)))
    frame = spark.createDataFrame(pairs, "a long, b long")
    shared = F.arrays_overlap(decontam.blocks(F.col("a")), decontam.near_blocks(F.col("b")))
    assert frame.filter(~shared).count() == 0
    assert frame.filter(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) == decontam.RADIUS).count() == 200


def test_clean_documents_keep_their_columns(spark, documents):
    rows, items = planted()
    kept = decontam.clean_documents(documents(rows), item_table(spark, items))
    dirty = {i for i, _ in brute_leaks(rows, items)}
    assert kept.columns == ["doc_id", "text", "block", "key"]
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(str(i) for i, _ in rows if i not in dirty)


def test_stages_follow_each_other(spark):
    """Each stage against brute force over all that the stage before it kept."""
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    columns = docs.columns
    listed = lambda df: [(r.doc_id, r.text) for r in df.collect()]
    rows = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = spark.createDataFrame(stage(spark, docs, FOLDER).toPandas(), docs.schema)
        assert docs.columns == columns
        rows[name] = listed(docs)
    everything = listed(spark.read.parquet(f"{FOLDER}/documents.parquet"))
    assert 0.6 * len(everything) < len(rows["quality"]) < len(everything)
    shortened = {i: n for i, _, n, _ in brute_lines(rows["quality"])}
    assert len(rows["line dedup"]) == len(rows["quality"]) and any(shortened.values())
    lengths = {i: len((t or "").split("\n")) for i, t in rows["quality"]}
    for i, text in rows["line dedup"]:
        assert len((text or "").split("\n")) == max(1, lengths[i] - shortened[i])
    expected = {i for i, _, component in brute_components(rows["line dedup"]) if i == component}
    assert {i for i, _ in rows["n-gram Jaccard join"]} == expected
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    dirty = {i for i, _ in brute_leaks(rows["n-gram Jaccard join"], items)}
    assert {i for i, _ in rows["decontamination"]} == expected - dirty
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, FOLDER).collect()
    check_packing(pieces, rows["decontamination"], 2048)


def test_all_queries_are_registered():
    assert set(QUERIES) <= set(registry.queries()) and set(SQL) <= set(registry.oracle_sql())
    assert {int(n[2:].split("_")[0]) for n in QUERIES if n.startswith("op")} == set(range(1, 14))
    assert [name for name, _ in corpus_pipeline.STAGES][-1] == "packing" and corpus_pipeline.ORACLE_SQL is None


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_agrees_with_sql(spark, name):
    from compare import database, differences

    assert differences(spark, database(FOLDER), name, FOLDER) is None
