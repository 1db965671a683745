"""A keyed table on Parquet files which keeps its versions and its change feed.

Layout below the table's path::

    rows/_version=<n>/<partition folders>/       rows of the partitions rewritten in commit n
    changes/_commit_version=<n>/<partition ...>/ change images of commit n
    commits/_version=<n>/                        one row about commit n, written last

The current rows are, per partition folder, those of the newest commit that rewrote it, and of the
commits that have only added rows to it since. A commit therefore writes only the partitions it
touches, nothing but its new rows where none goes, and nothing a reader may be using is changed. A
commit without its row in ``commits`` does not exist for readers. One writer at a time.
"""

from __future__ import annotations

import json
from collections import OrderedDict
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, field
from datetime import datetime, timedelta
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from lakeops.operators import changes as feed_of
from lakeops.operators.merge import (
    DELETED,
    check_unique,
    complete_keys,
    merge_pairs,
    sync_pairs,
    unique_in_folders,
    unique_keys,
)
from lakeops.sources.files import folder_times, matching_folders
from lakeops.sources.writers import FEW_FOLDERS, overwrite_counted

# ``detail`` is JSON: schema, partition columns, the newest commit of each partition folder, the earlier
# ones whose rows are still part of it, the keys by which loads have kept rows unique, and properties. It describes the whole table, so a reader needs the newest commit row only.
COMMIT_SCHEMA = (
    "version bigint, committed_at timestamp, operation string, inserted bigint, updated bigint, "
    "deleted bigint, detail string"
)
# Fixed value: how Spark names the folder of a missing partition value.
NO_VALUE = "__HIVE_DEFAULT_PARTITION__"
CREATE, OVERWRITE, MERGE, SYNC = "create", "overwrite", "merge", "sync"
# These commits replace all rows. Their feed is derived from the rows, not stored once more.
_WHOLE = (CREATE, OVERWRITE)
# A folder that rows were added to so many times is rewritten by the next commit that touches it.
MOST_ADDED = 8


@dataclass
class State:
    """What one version of the table consists of."""

    version: int
    committed_at: datetime
    schema: StructType
    partition_by: list[str]
    folders: dict[str, int]
    properties: dict[str, str] = field(default_factory=dict)
    operation: str = ""
    older: dict[str, list[int]] = field(default_factory=dict)
    keys: list[str] = field(default_factory=list)


# Versions never change once they are there, so their states are kept, by path, version and the time of
# the commit's folder, which tells a table that was dropped and made again at the same place.
_KNOWN: OrderedDict[tuple[str, int, int], State] = OrderedDict()
_MOST_KNOWN = 1_000


def _remember(key: tuple[str, int, int], state: State) -> None:
    _KNOWN[key] = state
    while len(_KNOWN) > _MOST_KNOWN:
        _KNOWN.popitem(last=False)


class VersionedTable:
    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path.rstrip("/")

    @classmethod
    def for_name(cls, spark: SparkSession, name: str) -> VersionedTable:
        """The table ``database.table``, found below the database's location."""
        database, table = name.split(".")
        location = spark.catalog.getDatabase(database).locationUri
        return cls(spark, f"{location.rstrip('/')}/{table}")

    # --- reading -------------------------------------------------------------------------------

    def _versions(self) -> dict[int, int]:
        """Numbers of the commits, from the names of their folders, and the times of these."""
        found = folder_times(self.spark, f"{self.path}/commits")
        return {int(name.partition("=")[2]): time for name, time in found.items()}

    def _commits(self) -> DataFrame:
        return self.spark.read.schema(COMMIT_SCHEMA).parquet(f"{self.path}/commits")

    def _states(self, versions: Mapping[int, int]) -> dict[int, State]:
        """The states of some versions; one job for all that are not known yet.

        A commit that was not written to its end has none.
        """
        keys = {number: (self.path, number, time) for number, time in versions.items()}
        missing = [number for number, key in keys.items() if key not in _KNOWN]
        if missing:
            paths = [f"{self.path}/commits/_version={number}" for number in missing]
            rows = self.spark.read.schema(COMMIT_SCHEMA).parquet(*paths).collect()
            for row in rows:
                detail = json.loads(row["detail"])
                state = State(
                    row["version"],
                    row["committed_at"],
                    StructType.fromJson(detail["schema"]),
                    detail["partition_by"],
                    detail["folders"],
                    detail["properties"],
                    row["operation"],
                    detail.get("older", {}),
                    detail.get("keys", []),
                )
                _remember(keys[state.version], state)
        return {number: _KNOWN[key] for number, key in keys.items() if key in _KNOWN}

    def find_state(self, version: int | None = None) -> State | None:
        """The table at a version, by default the newest; None if there is no such version."""
        versions = self._versions()
        for number in sorted(versions, reverse=True) if version is None else versions.keys() & {version}:
            state = self._states({number: versions[number]}).get(number)
            if state is not None:
                return state
        return None

    def state(self, version: int | None = None) -> State:
        """As ``find_state``, but a missing version is an error."""
        state = self.find_state(version)
        if state is None:
            raise ValueError(f"no version {version} of table {self.path}")
        return state

    def exists(self) -> bool:
        return self.find_state() is not None

    def _rows(self, state: State, only: set[str] | None = None) -> DataFrame:
        base = f"{self.path}/rows"
        paths = [
            f"{base}/_version={version}/{folder}".rstrip("/")
            for folder, newest in sorted(state.folders.items())
            if only is None or folder in only
            for version in (*state.older.get(folder, ()), newest)
        ]
        if not paths:
            return self.spark.createDataFrame([], state.schema)
        reader = self.spark.read.schema(state.schema).option("basePath", base)
        return reader.parquet(*paths).select(*state.schema.names)

    def read(self, version: int | None = None) -> DataFrame:
        """The rows at a version, by default the newest."""
        return self._rows(self.state(version))

    def near(self, source: DataFrame, keys: Sequence[str], state: State | None = None) -> DataFrame:
        """The rows in which partners of the source can be found.

        If the partition columns belong to the key, those are the partitions which the source
        names: its folder names are joined with those of the table, and only the hits, of which
        there are no more than the table has folders, come to the driver.
        """
        state = state or self.state()
        columns = state.partition_by
        if not columns or not set(columns) <= set(keys):
            return self._rows(state)
        return self._rows(state, only=self._named(source, state, state.folders))

    def _named(self, rows: DataFrame, state: State, folders: Iterable[str]) -> set[str]:
        """Those of some folders which the partition columns of the rows name."""
        named = rows.select(self._folder_of(state).alias("folder")).distinct()
        # Folder names have some letters of the values escaped.
        known = [(folder, unquote(folder)) for folder in folders]
        table = self.spark.createDataFrame(known, "escaped string, folder string")
        return {hit["escaped"] for hit in table.join(named, "folder", "left_semi").collect()}

    def _folder_of(self, state: State) -> Column:
        """The partition folder of a row, without escaped letters; empty if there are no partition columns."""
        parts = [
            F.concat(
                F.lit(f"{c}="), F.coalesce(F.col(c).cast(state.schema[c].dataType).cast("string"), F.lit(NO_VALUE))
            )
            for c in state.partition_by
        ]
        return F.concat_ws("/", *parts)

    def _losses(self, gone: DataFrame, state: State, folders: set[str]) -> dict[str, bool]:
        """Those of some folders from which rows go, and whether some of their rows stay.

        The rows of the folders are counted, not read: Parquet files say how many they hold. One job, which
        brings a row per folder to the driver.
        """
        one, none = F.lit(1).alias("gone"), F.lit(0).alias("gone")
        folder = self._folder_of(state).alias("folder")
        both = gone.select(folder, one).union(self._rows(state, only=folders).select(folder, none))
        counted = both.groupBy("folder").agg(F.sum("gone").alias("gone"), F.count(F.lit(1)).alias("all"))
        known = {unquote(name): name for name in folders}
        hits = counted.where("gone > 0").collect()
        return {known[hit["folder"]]: hit["all"] > 2 * hit["gone"] for hit in hits}

    def one_image_a_key(self, first_version: int, keys: Sequence[str]) -> bool:
        """Whether the feed from a version on is one commit of a table which loads keep unique by the keys.

        Besides images from before an update such a feed holds each key once.
        """
        versions = {n: t for n, t in self._versions().items() if n >= first_version}
        states = list(self._states(versions).values())
        return len(states) == 1 and set(states[0].keys) == set(keys)

    def history(self) -> DataFrame:
        """One row per commit."""
        self.state()
        return self._commits().select(
            "version", "committed_at", "operation", "inserted", "updated", "deleted"
        )

    def changes(
        self, first_version: int | None = None, since: datetime | None = None
    ) -> DataFrame:
        """The change feed from a version or from a time on, the start included.

        The feed is partitioned by commit, so earlier commits are not read. A start after the
        newest commit gives an empty feed. Columns that an overwrite has taken away are shown, behind
        the others, in the images of the rows that had them.
        """
        versions = {n: t for n, t in self._versions().items() if first_version is None or n >= first_version}
        states = sorted(self._states(versions).values(), key=lambda state: state.version)
        wanted = [state for state in states if since is None or state.committed_at >= since]
        schema = self._feed_schema([c.version for c in wanted if c.operation == OVERWRITE and c.version])
        schema.add(feed_of.CHANGE_TYPE, "string").add(feed_of.VERSION, "long")
        schema.add(feed_of.COMMIT_TIME, "timestamp")
        base = f"{self.path}/changes"
        stored = [
            f"{base}/{feed_of.VERSION}={c.version}" for c in wanted if c.operation not in _WHOLE
        ]
        parts = []
        if stored:
            reader = self.spark.read.schema(schema).option("basePath", base)
            parts.append(reader.parquet(*stored).select(*schema.names))
        for commit in wanted:
            if commit.operation not in _WHOLE:
                continue
            version = commit.version
            new = self._rows(commit)
            images = [new.withColumn(feed_of.CHANGE_TYPE, F.lit(feed_of.INSERTED))]
            if version > 0:
                old = self._rows(self.state(version - 1))
                images.append(old.withColumn(feed_of.CHANGE_TYPE, F.lit(feed_of.DELETED_ROW)))
            parts += [feed_of.stamped(i, version, commit.committed_at) for i in images]
        if not parts:
            return self.spark.createDataFrame([], schema)
        # Every part gets all columns, also where no row of the feed has them.
        feed = self.spark.createDataFrame([], schema)
        for part in parts:
            feed = feed.unionByName(part, allowMissingColumns=True)
        return feed.select(*schema.names)

    def _feed_schema(self, overwrites: Sequence[int]) -> StructType:
        """The newest columns, and those that the given overwrites took away."""
        schema = StructType(list(self.state().schema.fields))
        for version in overwrites:
            for state in (self.state(version - 1), self.state(version)):
                for field in state.schema.fields:
                    if field.name not in schema.names:
                        schema.add(field.name, field.dataType, True)
                    elif schema[field.name].dataType != field.dataType:
                        raise ValueError(f"column {field.name} had another type in version {state.version}")
        return schema

    # --- writing -------------------------------------------------------------------------------

    def _folders(self, path: str, partition_by: Sequence[str]) -> set[str]:
        """Partition folders below a path, by one listing."""
        if not partition_by:
            return {""}
        root = f"/{path.rsplit('/', 1)[-1]}/"
        found = matching_folders(self.spark, path + "/*=*" * len(partition_by))
        return {folder.rsplit(root, 1)[-1] for folder in found}

    def _write_rows(
        self,
        rows: DataFrame,
        version: int,
        partition_by: Sequence[str],
        operation: str,
        committed_at: datetime,
        counts: Mapping[str, int],
        kept: Mapping[str, int],
        properties: Mapping[str, str],
        keys: Sequence[str] = (),
        older: Mapping[str, list[int]] | None = None,
        gathered: bool = False,
        check: bool = False,
    ) -> int:
        """Write rows and the commit; ``kept`` are the folders which stay as they are.

        With ``check`` a key which occurs twice in the rows written fails ahead of the commit.
        """
        target = f"{self.path}/rows/_version={version}"
        count = overwrite_counted(rows, target, partition_by, gathered, rows=F.count(F.lit(1)))["rows"]
        if operation in _WHOLE:
            counts = {**counts, "inserted": count}
        written = self._folders(target, partition_by)
        folders = {**kept, **{folder: version for folder in written}}
        state = State(version, committed_at, rows.schema, list(partition_by), folders, dict(properties))
        state.older, state.keys = dict(older or {}), list(keys)
        if check:
            check_unique(self._rows(state, only=written), keys)
        return self._write_commit(state, operation, counts)

    def _write_commit(self, state: State, operation: str, counts: Mapping[str, int]) -> int:
        """The row which makes a version visible."""
        detail = {
            "schema": state.schema.jsonValue(),
            "partition_by": state.partition_by,
            "folders": state.folders,
            "older": state.older,
            "keys": state.keys,
            "properties": state.properties,
        }
        values = [
            state.version,
            state.committed_at,
            operation,
            *[counts.get(name, 0) for name in ("inserted", "updated", "deleted")],
            json.dumps(detail),
        ]
        fields = StructType.fromDDL(COMMIT_SCHEMA).fields
        row = self.spark.range(1).select(
            *[F.lit(value).cast(f.dataType).alias(f.name) for f, value in zip(fields, values)]
        )
        row.coalesce(1).write.mode("error").parquet(f"{self.path}/commits/_version={state.version}")
        state.operation = operation
        _remember((self.path, state.version, self._versions()[state.version]), state)
        return state.version

    def _commit_time(self, given: datetime | None, last: datetime | None) -> datetime:
        if given is None:
            given = datetime.now()
            if last is not None and given <= last:
                given = last + timedelta(milliseconds=1)
        elif last is not None and given < last:
            raise ValueError("a commit cannot be older than the one before it")
        return given

    def create(
        self,
        rows: DataFrame,
        partition_by: Sequence[str] = (),
        committed_at: datetime | None = None,
        properties: Mapping[str, str] | None = None,
        gathered: bool = False,
    ) -> int:
        """Version 0; ``gathered`` rows are not shuffled by partition before they are written."""
        return self._create(rows, partition_by, committed_at, properties, gathered=gathered)

    def _create(
        self, rows, partition_by, committed_at, properties=None, keys=(), gathered=False, check=False
    ) -> int:
        if self.find_state() is not None:
            raise ValueError(f"table {self.path} exists already")
        when = self._commit_time(committed_at, None)
        return self._write_rows(
            rows, 0, partition_by, CREATE, when, {}, {}, properties or {}, keys, gathered=gathered, check=check
        )

    def overwrite(
        self,
        rows: DataFrame,
        partition_by: Sequence[str] | None = None,
        committed_at: datetime | None = None,
    ) -> int:
        """Replace all rows; the feed shows every old row deleted and every new row inserted.

        Properties stay, so a load goes on behind what it consumed before.
        """
        state = self.find_state()
        if state is None:
            return self.create(rows, partition_by or (), committed_at)
        columns = state.partition_by if partition_by is None else partition_by
        when = self._commit_time(committed_at, state.committed_at)
        counts = {"deleted": self._rows(state).count()}
        return self._write_rows(
            rows, state.version + 1, columns, OVERWRITE, when, counts, {}, state.properties
        )

    def commit(
        self,
        pairs: DataFrame,
        keys: Sequence[str],
        operation: str = MERGE,
        committed_at: datetime | None = None,
        properties: Mapping[str, str] | None = None,
        state: State | None = None,
        note: bool = False,
    ) -> int | None:
        """Store a merge described by pairs; None, and no commit, if it changes nothing.

        With ``note`` properties are committed even if no row changes.

        The images are written first. They tell which partitions to rewrite, and they supply the
        new rows, so the merge join runs once. Partitions from which no row goes are added to. A table
        of few partitions is written by the tasks that have the rows, without a shuffle by partition.
        """
        state = state or self.state()
        version = state.version + 1
        when = self._commit_time(committed_at, state.committed_at)
        gathered = len(state.folders) <= FEW_FOLDERS
        # A merge may set key columns; a load keeps them.
        unique = state.keys if operation == SYNC and set(state.keys) == set(keys) else []
        base = f"{self.path}/changes"
        target = f"{base}/{feed_of.VERSION}={version}"
        images = feed_of.change_images(pairs).withColumn(
            feed_of.COMMIT_TIME, F.lit(when).cast("timestamp")
        )
        kind = F.col(feed_of.CHANGE_TYPE)
        counts = overwrite_counted(
            images,
            target,
            state.partition_by,
            gathered,
            inserted=F.count_if(kind == feed_of.INSERTED),
            updated=F.count_if(kind == feed_of.AFTER_UPDATE),
            deleted=F.count_if(kind == feed_of.DELETED_ROW),
        )
        told = {**state.properties, **(properties or {})}
        if not any(counts.values()):
            if not note or told == state.properties:
                return None
            noted = State(version, when, state.schema, state.partition_by, state.folders, told)
            noted.older, noted.keys = state.older, unique
            return self._write_commit(noted, operation, counts)
        stored = (
            self.spark.read.schema(images.schema)
            .option("basePath", base)
            .parquet(target)
            .select(*images.columns)
        )
        gone = stored.where(kind.isin(feed_of.BEFORE_UPDATE, feed_of.DELETED_ROW))
        came = stored.where(kind.isin(feed_of.INSERTED, feed_of.AFTER_UPDATE))
        touched = self._folders(target, state.partition_by)
        present = touched & state.folders.keys()
        losing = {folder for folder in present if len(state.older.get(folder, ())) >= MOST_ADDED - 1}
        partly = set(losing)
        if counts["updated"] or counts["deleted"]:
            losses = self._losses(gone, state, present)
            losing |= losses.keys()
            # A folder from which all rows go is replaced; only in others are those which stay looked up.
            partly = {folder for folder in losing if losses.get(folder, True)}
        rows = came.select(*state.schema.names)
        if partly:
            unchanged = self._rows(state, only=partly).join(gone.select(*keys), list(keys), "left_anti")
            rows = unchanged.select(*state.schema.names).unionByName(rows)
        kept = {folder: v for folder, v in state.folders.items() if folder not in losing}
        older = {folder: versions for folder, versions in state.older.items() if folder not in losing}
        for folder in present - losing:
            older[folder] = [*older.get(folder, ()), state.folders[folder]]
        return self._write_rows(
            rows, version, state.partition_by, operation, when, counts, kept, told, unique, older, gathered
        )

    def merge(
        self,
        source: DataFrame,
        keys: Sequence[str],
        committed_at: datetime | None = None,
        properties: Mapping[str, str] | None = None,
        **options,
    ) -> int | None:
        """Merge a source which is small next to the table; options as for ``merge_pairs``."""
        state = self.state()
        pairs = merge_pairs(
            self.near(source, keys, state), source, keys, whole_target=False, **options
        )
        return self.commit(pairs, keys, MERGE, committed_at, properties, state)

    def sync(
        self,
        source: DataFrame,
        keys: Sequence[str],
        committed_at: datetime | None = None,
        partition_by: Sequence[str] = (),
        grouped: bool = False,
        gathered: bool = False,
        **options,
    ) -> int | None:
        """Bring the table in line with a full extract; the first load creates it.

        A source ``grouped`` by the keys holds each once. The first load writes ``gathered`` rows as they lie
        in tasks, and looks for repeated keys in what it has written: whole rows are not shuffled.
        """
        state = self.find_state()
        if state is None and (grouped or gathered):
            rows = complete_keys(source, keys).withColumn(options.get("flag", DELETED), F.lit(False))
            return self._create(rows, partition_by, committed_at, keys=keys, gathered=gathered, check=not grouped)
        if state is None:
            dealt = bool(partition_by) and set(partition_by) <= set(keys)
            checked = unique_in_folders(source, keys, partition_by) if dealt else unique_keys(source, keys)
            rows = checked.withColumn(options.get("flag", DELETED), F.lit(False))
            return self._create(rows, partition_by, committed_at, keys=keys, gathered=dealt)
        pairs = sync_pairs(self._rows(state), source, keys, grouped=grouped, **options)
        return self.commit(pairs, keys, SYNC, committed_at, state=state)

