"""Refined to curated: dimensions with surrogate ids, then the fact table.

A load reads the change feed behind the version it consumed last. That version is kept in the
properties of the loaded table's commits, so finding it costs no scan of the table.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F

from lakeops.operators import changes as feed_of
from lakeops.operators.merge import DELETED, INSERT, merge_pairs
from lakeops.operators.numbering import assign_ids_upto, highest_id
from lakeops.operators.relate import fact_lookup
from lakeops.plans.jobs import run_tables
from lakeops.session import scratch, written
from lakeops.sources.writers import few_folders, overwrite
from lakeops.tables.versioned import MERGE, State, VersionedTable

MODIFIED = "last_modified"
CONSUMED = "consumed"
HIGHEST = "highest_id"
REJECTS = "rejects"


@dataclass(frozen=True)
class Dimension:
    """A refined table, the dimension made of it, its business key and its id column.

    A large dimension can be partitioned by columns that do not change for a key: a load then rewrites
    the partitions of changed rows only.
    """

    source: str
    name: str
    key: str
    id_column: str
    partition_by: Sequence[str] = ()


# The dimensions of the price star, and the key of its fact table.
PRICE_DIMENSIONS = (
    Dimension("area", "dim_area", "area_code", "dim_area_id"),
    Dimension("series", "dim_series", "series_id", "dim_series_id"),
    Dimension("item", "dim_item", "item_code", "dim_item_id"),
)
READING_KEY = ["series_id", "year", "period"]
FACT_KEY = ["dim_series_id", "year", "period"]


def as_rows(latest: DataFrame) -> DataFrame:
    """Newest images as rows; a removed row comes back marked deleted."""
    gone = F.col(feed_of.CHANGE_TYPE) == feed_of.DELETED_ROW
    marked = latest.withColumn(DELETED, F.col(DELETED) | gone)
    return feed_of.as_rows(marked, MODIFIED)


def new_images(
    source: VersionedTable, state: State | None, keys: Sequence[str]
) -> tuple[DataFrame | None, int, bool]:
    """The newest image of each key behind what a table consumed, None if there is none; the version
    that it reaches; and whether the images are a plain read.

    One commit of a table that loads keep unique by the keys has them as they are: none is searched.
    """
    first = 0 if state is None else int(state.properties.get(CONSUMED, "-1")) + 1
    newest = source.state().version
    if first > newest:
        return None, newest, True
    feed = source.changes(first)
    if source.one_image_a_key(first, keys):
        return feed.where(F.col(feed_of.CHANGE_TYPE) != feed_of.BEFORE_UPDATE), newest, True
    return feed_of.latest_changes(feed, keys), newest, False


def dimension_pairs(
    dimension: DataFrame, rows: DataFrame, key: str, id_column: str, highest: int
) -> tuple[DataFrame, int]:
    """Pairs of a dimension merge, and the highest id after it.

    Known rows keep their id. Only new rows are sorted, to get the numbers after the highest one in
    key order.
    """
    settings = {c: F.col(f"s.`{c}`") for c in rows.columns}
    pairs = merge_pairs(
        dimension, rows, [key], update=settings, insert=settings, whole_target=False, check_keys=False
    )
    pairs = written(pairs, "dimension-pairs")
    is_new = F.col("action") == INSERT
    numbered, top = assign_ids_upto(pairs.where(is_new).select("after.*"), id_column, [key], highest)
    inserted = numbered.select(
        F.lit(None).cast(pairs.schema["t"].dataType).alias("t"),
        F.lit(INSERT).alias("action"),
        F.struct(*dimension.columns).alias("after"),
    )
    return pairs.where(~is_new).unionByName(inserted), top


def load_dimension(
    source: VersionedTable,
    target: VersionedTable,
    key: str,
    id_column: str,
    committed_at: datetime | None = None,
    partition_by: Sequence[str] = (),
) -> int | None:
    """Merge new changes into a dimension; None if there are none.

    ``partition_by`` holds for the first load, which creates the table.
    """
    with scratch(target.spark):
        return _load_dimension(source, target, key, id_column, committed_at, partition_by)


def _load_dimension(source, target, key, id_column, committed_at, partition_by) -> int | None:
    state = target.find_state()
    images, newest, plain = new_images(source, state, [key])
    if images is None:
        return None
    rows = as_rows(images)
    done = {CONSUMED: str(newest)}
    if state is None:
        numbered, top = assign_ids_upto(rows, id_column, [key])
        return target.create(numbered, partition_by, committed_at, {**done, HIGHEST: str(top)})
    known = target.read()
    highest = int(state.properties.get(HIGHEST) or highest_id(known, id_column))
    rows = rows if plain else written(rows, "dimension-rows")
    pairs, top = dimension_pairs(known, rows, key, id_column, highest)
    return target.commit(pairs, [key], MERGE, committed_at, {**done, HIGHEST: str(top)}, state)


def _rejects_path(fact: VersionedTable, load: str) -> str:
    return f"{fact.path}/{REJECTS}/_load={load}"


def load_fact(
    source: VersionedTable,
    dimensions: dict[str, DataFrame],
    target: VersionedTable,
    committed_at: datetime | None = None,
    partition_by: Sequence[str] = (),
) -> int | None:
    """Merge new readings into the fact table; None if there are none.

    A reading whose series is unknown has no fact key. It is put aside and tried again by the next
    load; ``rejects`` shows what is waiting.
    """
    with scratch(target.spark):
        return _load_fact(source, dimensions, target, committed_at, partition_by)


def _load_fact(source, dimensions, target, committed_at, partition_by) -> int | None:
    state = target.find_state()
    images, newest, _ = new_images(source, state, READING_KEY)
    if images is None:
        return None
    spark = target.spark
    waits = state is not None and state.properties.get(REJECTS)
    if waits:
        waiting = spark.read.schema(images.schema).parquet(
            _rejects_path(target, state.properties[REJECTS])
        )
        images = images.unionByName(waiting)
    found = fact_lookup(images, dimensions["series"], dimensions["area"], dimensions["item"])
    if waits:
        # A join by series leaves the images of a reading together: this needs no shuffle behind it.
        found = feed_of.latest_changes(found, READING_KEY)
    # One join, stored for facts and rejects. Only a reading whose series is unknown keeps its name.
    unknown = F.col("dim_series_id").isNull()
    found = written(found.withColumn("series_id", F.when(unknown, F.col("series_id"))), "fact-rows")
    load = str(0 if state is None else state.version + 1)
    overwrite(found.where(unknown).select(*images.columns), _rejects_path(target, load))
    done = {CONSUMED: str(newest), REJECTS: load}

    facts = as_rows(found.where(~unknown).drop("series_id"))
    if state is None:
        few = bool(partition_by) and few_folders(facts, partition_by)
        return target.create(facts, partition_by, committed_at, done, gathered=few)
    # One row per reading key and one series per series id, so the fact key is unique.
    near = target.near(facts, FACT_KEY, state)
    pairs = merge_pairs(near, facts, FACT_KEY, whole_target=False, check_keys=False)
    # What waits now must be seen even if no reading found its series.
    return target.commit(pairs, FACT_KEY, MERGE, committed_at, done, state, note=True)


def rejects(fact: VersionedTable) -> DataFrame:
    """Readings which wait for their series."""
    return fact.spark.read.parquet(_rejects_path(fact, fact.state().properties[REJECTS]))


def load_star(
    spark: SparkSession,
    refined_root: str,
    curated_root: str,
    committed_at: datetime | None = None,
    fact_source: str = "current",
    fact_name: str = "fact_current",
    partition_by: Sequence[str] = (),
    dimensions: Sequence[Dimension] = PRICE_DIMENSIONS,
    workers: int = 3,
    seconds: float | None = None,
) -> DataFrame:
    """Load all dimensions side by side, then the fact table; one status row per table.

    If a dimension fails, or takes more than ``seconds``, the fact table is left as it is.
    """

    def table(root: str, name: str) -> VersionedTable:
        return VersionedTable(spark, f"{root}/{name}")

    by_name = {d.name: d for d in dimensions}

    def load(name: str) -> int | None:
        d = by_name[name]
        return load_dimension(
            table(refined_root, d.source), table(curated_root, name), d.key, d.id_column, committed_at, d.partition_by
        )

    status = run_tables(spark, by_name, load, workers, seconds)
    current = {d.source: table(curated_root, d.name).read() for d in dimensions}
    fact = run_tables(
        spark,
        [fact_name],
        lambda name: load_fact(
            table(refined_root, fact_source), current, table(curated_root, name), committed_at, partition_by
        ),
    )
    return status.unionByName(fact)
