"""A keyed table stored in buckets of its key, so that loads leave its rows where they are.

Each load joins the stored rows with a source. Rows of the table are read bucket by bucket, already
dealt by key, so only the source is shuffled, straight into the table's buckets. What comes out of the
join is still dealt by key and is written to the buckets of the next generation without a shuffle.

A generation is an ordinary table of the session catalog, ``name_g<n>``; the view ``name`` shows the
newest. Readers keep the generation they have begun with: the one before the newest stays.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from lakeops.operators.merge import DELETED, merge_pairs, merged_rows, sync_pairs, unique_keys

KEPT = 2


class BucketedTable:
    """``name`` may have a database in front; all writers must give the same keys and buckets."""

    def __init__(self, spark: SparkSession, name: str, keys: Sequence[str], buckets: int):
        self.spark, self.name, self.keys, self.buckets = spark, name, list(keys), buckets

    def _generations(self) -> list[int]:
        database, _, table = self.name.rpartition(".")
        pattern = re.compile(re.escape(table.lower()) + r"_g(\d+)")
        names = (t.name.lower() for t in self.spark.catalog.listTables(database or None))
        return sorted(int(found[1]) for found in map(pattern.fullmatch, names) if found)

    def exists(self) -> bool:
        return bool(self._generations())

    def read(self) -> DataFrame:
        """The newest rows."""
        generations = self._generations()
        if not generations:
            raise ValueError(f"no table {self.name}")
        return self.spark.table(f"{self.name}_g{generations[-1]}")

    def near(self, source: DataFrame) -> DataFrame:
        """A source dealt to the buckets of the table, which later steps by key need not shuffle again."""
        return source.repartition(self.buckets, *self.keys)

    def _store(self, rows: DataFrame) -> None:
        generations = self._generations()
        number = generations[-1] + 1 if generations else 0
        writer = rows.write.format("parquet").bucketBy(self.buckets, *self.keys).sortBy(*self.keys)
        writer.mode("error").saveAsTable(f"{self.name}_g{number}")
        self.spark.sql(f"CREATE OR REPLACE VIEW {self.name} AS SELECT * FROM {self.name}_g{number}")
        for old in [*generations, number][:-KEPT]:
            self.spark.sql(f"DROP TABLE {self.name}_g{old}")

    def create(self, rows: DataFrame) -> None:
        """The first generation, from rows whose key is unique."""
        if self.exists():
            raise ValueError(f"table {self.name} exists already")
        self._store(unique_keys(self.near(rows), self.keys))

    def sync_plan(self, extract: DataFrame, **options) -> DataFrame:
        """The table in line with a full extract, not yet stored; options as for ``sync_pairs``."""
        return merged_rows(sync_pairs(self.read(), self.near(extract), self.keys, **options))

    def sync(self, extract: DataFrame, **options) -> None:
        """Bring the table in line with a full extract; the first load creates it."""
        if not self.exists():
            self.create(extract.withColumn(options.get("flag", DELETED), F.lit(False)))
            return
        self._store(self.sync_plan(extract, **options))

    def merge_plan(self, source: DataFrame, **options) -> DataFrame:
        """The table after a keyed merge, not yet stored; options as for ``merge_pairs``."""
        return merged_rows(merge_pairs(self.read(), self.near(source), self.keys, **options))

    def merge(self, source: DataFrame, **options) -> None:
        self._store(self.merge_plan(source, **options))
