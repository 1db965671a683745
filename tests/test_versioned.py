from __future__ import annotations

import os
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from lakeops.operators import changes
from lakeops.tables.versioned import VersionedTable

T0, T1, T2 = (datetime(2022, 1, d) for d in (1, 2, 3))
SCHEMA = "k int, part string, v double"


@pytest.fixture
def table(spark, path):
    return VersionedTable(spark, path)


def frame(spark, *rows):
    return spark.createDataFrame(list(rows), SCHEMA)


def test_sync_creates_then_commits_then_rests(spark, table, rows):
    first = frame(spark, (1, "a", 1.0), (2, "b", 2.0))
    assert not table.exists()
    assert table.sync(first, ["k"], T0, partition_by=["part"]) == 0
    second = frame(spark, (1, "a", 1.0), (2, "b", 5.0), (3, "c", 3.0))
    assert table.sync(second, ["k"], T1) == 1
    assert table.sync(second, ["k"], T2) is None
    assert rows(table.read(), "k", "part", "v", "is_deleted") == [
        (1, "a", 1.0, False), (2, "b", 5.0, False), (3, "c", 3.0, False)]
    assert rows(table.read(0), "k", "v") == [(1, 1.0), (2, 2.0)]
    assert rows(table.history().drop("committed_at")) == [(0, "create", 2, 0, 0), (1, "sync", 1, 1, 0)]


def test_commit_writes_only_touched_partitions(spark, table, path):
    table.sync(frame(spark, (1, "a", 1.0), (2, "b", 2.0), (3, "c", 3.0)), ["k"], T0, partition_by=["part"])
    table.sync(frame(spark, (1, "a", 1.0), (2, "b", 9.0), (3, "c", 3.0)), ["k"], T1)
    assert [d for d in os.listdir(f"{path}/rows/_version=1") if "=" in d] == ["part=b"]
    assert table.state().folders == {"part=a": 0, "part=b": 1, "part=c": 0}


def test_row_moves_to_another_partition(spark, table, rows):
    table.sync(frame(spark, (1, "a", 1.0), (2, "b", 2.0)), ["k"], T0, partition_by=["part"])
    table.sync(frame(spark, (1, "z z/é", 1.0), (2, "b", 2.0)), ["k"], T1)
    assert rows(table.read(), "k", "part") == [(1, "z z/é"), (2, "b")]
    assert set(table.state().folders.values()) == {0, 1} and len(table.state().folders) == 2
    table.sync(frame(spark, (1, "z z/é", 4.0), (2, "b", 2.0)), ["k"], T2)
    assert rows(table.read(), "k", "part", "v") == [(1, "z z/é", 4.0), (2, "b", 2.0)]


def test_text_partitions_keep_leading_zeros(spark, table, rows):
    table.sync(frame(spark, (1, "0010", 1.0), (2, None, 2.0)), ["k"], T0, partition_by=["part"])
    assert rows(table.read(), "k", "part") == [(1, "0010"), (2, None)]


def test_feed_by_version_and_time(spark, table, rows):
    table.create(frame(spark, (1, "a", 1.0)), (), T0)
    table.merge(frame(spark, (1, "a", 2.0), (2, "b", 2.0)), ["k"], T1)
    feed = table.changes(0)
    assert rows(feed, "k", "v", "_change_type", "_commit_version") == [
        (1, 1.0, "insert", 0), (1, 1.0, "update_preimage", 1), (1, 2.0, "update_postimage", 1),
        (2, 2.0, "insert", 1)]
    assert {r[0] for r in feed.select("_commit_timestamp").collect()} == {T0, T1}
    assert table.changes(since=T1).count() == 3
    assert table.changes(1).count() == 3
    assert table.changes(2).count() == 0
    assert rows(changes.replayed(feed, ["k"])) == rows(table.read())


def test_unconditional_merge_reports_equal_rows_as_updates(spark, table):
    table.create(frame(spark, (1, "a", 1.0), (2, "a", 1.0)), (), T0)
    assert table.merge(frame(spark, (1, "a", 1.0)), ["k"], T1) == 1
    assert table.changes(1).count() == 2


def test_overwrite_is_tracked_and_may_change_the_schema(spark, table, rows):
    table.overwrite(frame(spark, (1, "a", 1.0)), ["part"], T0)
    wider = frame(spark, (2, "b", 2.0)).withColumn("extra", F.lit("x"))
    table.overwrite(wider, committed_at=T1)
    assert rows(table.read()) == [(2, "b", 2.0, "x")] or rows(table.read(), *wider.columns) == [(2, "b", 2.0, "x")]
    assert rows(table.changes(1), "k", "extra", "_change_type") == [(1, None, "delete"), (2, "x", "insert")]
    assert rows(table.read(0), "k") == [(1,)]


def test_unfinished_commit_is_invisible_and_can_be_repeated(spark, table, path, rows):
    table.create(frame(spark, (1, "a", 1.0)), ["part"], T0)
    frame(spark, (7, "a", 7.0)).write.partitionBy("part").parquet(f"{path}/rows/_version=1")
    assert rows(table.read(), "k") == [(1,)]
    table.merge(frame(spark, (2, "a", 2.0)), ["k"], T1)
    assert rows(table.read(), "k") == [(1,), (2,)]


def test_version_must_exist(spark, table):
    with pytest.raises(ValueError):
        table.state()
    table.create(frame(spark, (1, "a", 1.0)), (), T0)
    with pytest.raises(ValueError):
        table.read(4)
    with pytest.raises(ValueError):
        table.create(frame(spark, (1, "a", 1.0)))
    with pytest.raises(ValueError):
        table.merge(frame(spark, (2, "a", 2.0)), ["k"], datetime(2021, 1, 1))


def test_emptied_table_can_be_read_and_filled(spark, table, rows):
    table.create(frame(spark), ["part"], T0)
    assert table.read().count() == 0
    table.merge(frame(spark, (1, "a", 1.0)), ["k"], T1)
    assert rows(table.read(), "k") == [(1,)]


@pytest.mark.parametrize("partition_by", [["part"], ["part", "k"]])
def test_merge_opens_only_the_partitions_its_source_names(spark, table, rows, partition_by):
    table.create(frame(spark, (1, "a", 1.0), (2, "b", 2.0), (3, "c", 3.0)), partition_by, T0)
    source = frame(spark, (2, "b", 5.0), (9, "d", 9.0))
    near = table.near(source, ["k", "part"])
    opened = near.inputFiles()
    assert opened and all("/part=b/" in file for file in opened)
    assert rows(near, "k") == [(2,)]
    table.merge(source, ["k", "part"], T1)
    assert rows(table.read(), "k", "v") == [(1, 1.0), (2, 5.0), (3, 3.0), (9, 9.0)]


def test_partitions_outside_the_key_prune_nothing(spark, table):
    table.create(frame(spark, (1, "a", 1.0), (2, "b", 2.0)), ["part"], T0)
    moved = frame(spark, (1, "z", 1.0))
    assert table.near(moved, ["k"]).count() == 2
    table.merge(moved, ["k"], T1)
    assert {r["part"] for r in table.read().collect()} == {"z", "b"}


def test_overwrite_keeps_properties(spark, table, rows):
    table.create(frame(spark, (1, "a", 1.0)), (), T0, {"consumed": "3"})
    table.overwrite(frame(spark, (2, "b", 2.0)), None, T1)
    assert table.state().properties == {"consumed": "3"} and rows(table.read(), "k") == [(2,)]


def test_empty_string_is_no_partition_value(spark, table):
    with pytest.raises(Exception, match="empty string in partition column part"):
        table.create(frame(spark, (1, "", 1.0)), ["part"], T0)


def test_pruning_has_no_limit_on_partitions(spark, table):
    spread = [(i, f"p{i}", 1.0) for i in range(1_100)]
    table.create(frame(spark, *spread).coalesce(1), ["part"], T0)
    near = table.near(frame(spark, *spread[:1_050]), ["k", "part"])
    assert near.count() == 1_050


def test_feed_shows_columns_that_an_overwrite_took_away(spark, table, rows):
    table.create(frame(spark, (1, "a", 1.0), (2, "b", 2.0)), (), T0)
    table.overwrite(spark.createDataFrame([(7, "new")], "k int, w string"), (), T1)
    feed = table.changes(0)
    assert feed.columns[:4] == ["k", "w", "part", "v"]
    assert rows(feed, "k", "w", "part", "v", changes.CHANGE_TYPE, changes.VERSION) == [
        (1, None, "a", 1.0, "delete", 1), (1, None, "a", 1.0, "insert", 0), (2, None, "b", 2.0, "delete", 1),
        (2, None, "b", 2.0, "insert", 0), (7, "new", None, None, "insert", 1)]
    assert table.changes(2).columns[:2] == ["k", "w"] and table.changes(2).count() == 0
    table.overwrite(spark.createDataFrame([("x",)], "k string"), (), T2)
    with pytest.raises(ValueError, match="another type"):
        table.changes(0)


def test_partitions_that_lose_no_row_are_added_to(spark, table, path, rows):
    part = lambda version: spark.read.parquet(f"{path}/rows/_version={version}")
    table.sync(frame(spark, (1, "a", 1.0), (2, "b", 2.0)), ["k"], T0, partition_by=["part"])
    table.sync(frame(spark, (1, "a", 1.0), (2, "b", 5.0), (3, "a", 3.0), (4, "b", 4.0)), ["k"], T1)
    assert rows(part(1), "k", "part") == [(2, "b"), (3, "a"), (4, "b")]
    assert table.state().folders == {"part=a": 1, "part=b": 1} and table.state().older == {"part=a": [0]}
    everything = [(1, "a", 1.0, False), (2, "b", 5.0, False), (3, "a", 3.0, False), (4, "b", 4.0, False)]
    assert rows(table.read(), "k", "part", "v", "is_deleted") == everything
    assert rows(VersionedTable(spark, path).read(0), "k") == [(1,), (2,)]
    # A lost row rewrites all that the folder consists of.
    table.sync(frame(spark, (2, "b", 5.0), (3, "a", 3.0), (4, "b", 4.0)), ["k"], T2)
    assert rows(part(2), "k", "is_deleted") == [(1, True), (3, False)] and table.state().older == {}


def test_folders_are_rewritten_after_many_additions(spark, table, rows):
    from lakeops.tables.versioned import MOST_ADDED

    table.create(frame(spark, (0, "a", 0.0)), (), T0)
    for k in range(1, MOST_ADDED + 2):
        table.merge(frame(spark, (k, "a", 1.0)), ["k"], T1)
        assert len(table.state().older.get("", ())) < MOST_ADDED
    assert rows(table.read(), "k") == [(k,) for k in range(MOST_ADDED + 2)]


def test_first_load_into_folders_of_the_key_is_shuffled_once(spark, table):
    from lakeops.operators.merge import unique_in_folders

    source = frame(spark, (1, "a", 1.0), (1, "b", 2.0))
    plan = unique_in_folders(source, ["k", "part"], ["part"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1
    table.sync(source, ["k", "part"], T0, partition_by=["part"])
    assert table.state().keys == ["k", "part"] and table.read().count() == 2
    for wrong in [(1, "a", 7.0), (None, "a", 7.0)]:
        with pytest.raises(Exception, match="merge key"):
            VersionedTable(spark, f"{table.path}-x").sync(
                source.union(frame(spark, wrong)), ["k", "part"], T0, partition_by=["part"])


def test_each_key_of_one_load_is_known_to_have_one_image(spark, table):
    table.sync(frame(spark, (1, "a", 1.0)), ["k"], T0)
    assert table.one_image_a_key(0, ["k"]) and not table.one_image_a_key(0, ["part"])
    table.sync(frame(spark, (1, "a", 2.0)), ["k"], T1)
    assert table.one_image_a_key(1, ["k"]) and not table.one_image_a_key(0, ["k"])
    table.merge(frame(spark, (1, "a", 3.0)), ["k"], T2)
    assert not table.one_image_a_key(2, ["k"])


def test_only_folders_which_keep_rows_are_searched_for_them(spark, table, rows, monkeypatch):
    gone = {}
    losses = VersionedTable._losses
    monkeypatch.setattr(
        VersionedTable, "_losses", lambda *given: gone.update(losses(*given)) or losses(*given)
    )
    first = spark.createDataFrame(
        [(1, "a", 1), (2, "a", 1), (3, "b", 1), (4, "b", 1), (5, "c", 1), (6, "d/1", 1)], "k int, part string, v int"
    )
    table.sync(first, ["k", "part"], partition_by=["part"])
    # All of a is raised, one row of b, none of c; d/1 goes.
    second = spark.createDataFrame([(1, "a", 2), (2, "a", 2), (3, "b", 2), (4, "b", 1), (5, "c", 1)], first.schema)
    table.sync(second, ["k", "part"])
    assert gone == {"part=a": False, "part=b": True, "part=d%2F1": False}
    assert rows(table.read(), "k", "v", "is_deleted") == [
        (1, 2, False), (2, 2, False), (3, 2, False), (4, 1, False), (5, 1, False), (6, 1, True)
    ]


def test_a_table_without_folders_is_searched_if_rows_stay(spark, table, rows):
    first = spark.createDataFrame([(1, 1), (2, 1)], "k int, v int")
    table.sync(first, ["k"])
    table.sync(spark.createDataFrame([(1, 2), (2, 1)], first.schema), ["k"])
    assert rows(table.read(), "k", "v") == [(1, 2), (2, 1)]
    table.sync(spark.createDataFrame([(1, 3), (2, 3)], first.schema), ["k"])
    assert rows(table.read(), "k", "v") == [(1, 3), (2, 3)]


def test_stored_rows_keep_all_types_in_the_second_parquet_version(spark, path):
    import glob

    import pyarrow.parquet as pq

    from lakeops.sources.writers import overwrite

    many = spark.range(0, 60_000, 1, 1).selectExpr(
        "id", "concat('S', id, '-', id % 7) AS name", "CAST(id AS INT) AS i", "CAST(id % 100 AS TINYINT) AS b",
        "CAST(id AS DECIMAL(9, 2)) AS d9", "CAST(id AS DECIMAL(38, 4)) AS d38", "id / 7 AS x", "id % 3 = 0 AS flag",
        "CAST(CAST(id AS STRING) AS BINARY) AS raw", "timestamp_seconds(id) AS ts", "date_add(DATE'2020-01-01', CAST(id AS INT)) AS day",
        "IF(id % 5 = 0, NULL, array(id, -id)) AS numbers", "named_struct('a', id, 'b', concat('x', id)) AS pair",
    )
    overwrite(many, path)
    back = spark.read.parquet(path)
    assert back.dtypes == many.dtypes
    assert back.exceptAll(many).isEmpty() and many.exceptAll(back).isEmpty()
    file = pq.ParquetFile(glob.glob(f"{path.removeprefix('file:')}/*.parquet")[0])
    found = {e for c in range(file.metadata.num_columns) for e in file.metadata.row_group(0).column(c).encodings}
    assert "DELTA_BYTE_ARRAY" in found and "PLAIN_DICTIONARY" not in found


@pytest.mark.parametrize("keys, message", [([1, 2, 1], "several source rows"), ([1, None], "NULL in merge key")])
@pytest.mark.parametrize("partition_by", [[], ["part"]])
def test_keys_of_a_gathered_first_load_are_checked(spark, table, rows, keys, message, partition_by):
    def source(keys):
        return spark.createDataFrame([(k, "a", 1.0) for k in keys], SCHEMA)

    with pytest.raises(Exception, match=message):
        table.sync(source(keys), ["k", "part"], partition_by=partition_by, gathered=True)
    assert not table.exists()
    # The same table can be loaded then; what the failed load has left is no part of it.
    table.sync(source([1, 2]), ["k", "part"], partition_by=partition_by, gathered=True)
    assert rows(table.read(), "k", "is_deleted") == [(1, False), (2, False)]


def test_keys_which_share_a_hash_are_compared_as_they_are(spark, monkeypatch):
    from lakeops.operators import merge

    monkeypatch.setattr(merge.F, "xxhash64", lambda *columns: F.lit(7).cast("long"))
    merge.check_unique(spark.createDataFrame([(1,), (2,)], "k int"), ["k"])
    with pytest.raises(Exception, match="several source rows"):
        merge.check_unique(spark.createDataFrame([(1,), (2,), (2,)], "k int"), ["k"])


def test_a_gathered_first_load_shuffles_hashes_only(spark, table, monkeypatch):
    dealt = []
    repartition = type(spark.range(1)).repartition
    monkeypatch.setattr(
        type(spark.range(1)), "repartition", lambda df, *given: dealt.append(df.columns) or repartition(df, *given)
    )
    source = spark.createDataFrame([(1, "a", 1.0), (2, "b", 1.0)], SCHEMA)
    table.sync(source, ["k", "part"], partition_by=["part"], gathered=True)
    assert dealt == [["_hash"]]


def test_a_grouped_source_is_not_searched_for_repeated_keys(spark, table, rows):
    for value in (1, 2):
        grouped = spark.range(6).selectExpr("CAST(id % 3 AS INT) AS k", "'a' AS part", f"{value} AS v")
        grouped = grouped.groupBy("k", "part").agg(F.expr("CAST(sum(v) AS DOUBLE) AS v"))
        table.sync(grouped, ["k", "part"], partition_by=["part"], grouped=True, gathered=True)
    assert rows(table.read(), "k", "v") == [(0, 4.0), (1, 4.0), (2, 4.0)]
    missing = spark.createDataFrame([(None, "a", 1.0)], SCHEMA)
    with pytest.raises(Exception, match="NULL in merge key"):
        table.sync(missing, ["k", "part"], grouped=True)
