"""Keyed merge, soft delete and full synchronisation.

A merge is first described as *pairs*: one row per key with

* ``t``: the target row as a struct, NULL where the target lacks the key,
* ``s``: the source row as a struct, NULL where the source lacks the key,
* ``action``: ``insert``, ``update``, ``soft_delete`` or ``keep``,
* ``after``: the row which the target holds once the merge is done.

Both the merged rows and the change images come from the same pairs, that is, from one join.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window, functions as F

from lakeops.functions.change import any_changed, key_condition

DELETED = "is_deleted"
KEEP, INSERT, UPDATE, SOFT_DELETE = "keep", "insert", "update", "soft_delete"
Setting = Mapping[str, "str | Column"]


def unique_keys(df: DataFrame, keys: Sequence[str], dealt_by: Sequence[str] = ()) -> DataFrame:
    """The same rows; the job fails when a key is NULL or occurs twice.

    ``dealt_by`` are columns that follow from the key and by which the rows are dealt already.

    The window needs the partitioning and the order which the merge join on the same keys needs
    anyway, so the check adds no shuffle and no sort to it.
    """
    copies = F.count(F.lit(1)).over(Window.partitionBy(*dealt_by, *[k for k in keys if k not in dealt_by]))
    named = ", ".join(keys)
    fine = F.when(
        F.col("_copies") > 1,
        F.raise_error(F.lit(f"several source rows for one merge key ({named})")).cast("boolean"),
    ).otherwise(F.lit(True))
    # Rows without key fail ahead of the window, so they never gather in one of its tasks.
    return complete_keys(df, keys).withColumn("_copies", copies).where(fine).drop("_copies")


def complete_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The same rows; the job fails when a key is NULL."""
    missing = F.greatest(*[F.col(k).isNull() for k in keys]) if len(keys) > 1 else F.col(keys[0]).isNull()
    error = F.raise_error(F.lit(f"NULL in merge key ({', '.join(keys)})")).cast("boolean")
    return df.where(F.when(missing, error).otherwise(F.lit(True)))


def check_unique(stored: DataFrame, keys: Sequence[str]) -> None:
    """Fails as ``unique_keys`` does, for rows which are stored and may be read again.

    Only a hash of each key is shuffled. Keys that share one are compared as they are.
    """
    hashed = F.xxhash64(*keys).alias("_hash")
    hashes = stored.select(hashed).repartition("_hash").groupBy("_hash").count()
    shared = hashes.where("count > 1").select("_hash")
    if shared.count():
        suspects = stored.select(*keys, hashed).join(shared, "_hash", "left_semi").select(*keys)
        unique_keys(suspects, keys).count()


# Tasks of a shuffle that write into the same folder, at most, when rows are dealt by folder and key.
FILES_A_FOLDER = 16


def unique_in_folders(df: DataFrame, keys: Sequence[str], folders: Sequence[str]) -> DataFrame:
    """``unique_keys`` of rows which will be written to folders by some of their key columns.

    Rows are dealt once, by folder and a share of the keys: equal keys meet, and a folder's rows lie in a
    few tasks, so that neither the check nor the write needs a shuffle of its own. The share is told again
    behind the shuffle, not carried through it.
    """
    share = F.pmod(F.xxhash64(*keys), F.lit(FILES_A_FOLDER))
    dealt = df.repartition(*folders, share).withColumn("_share", share)
    return unique_keys(dealt, keys, [*folders, "_share"]).drop("_share")


def active(df: DataFrame, flag: str = DELETED) -> DataFrame:
    """Rows not marked deleted; an unknown mark counts as not active."""
    return df.where(~F.col(flag))


def missing_in(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Target rows whose key the source lacks.

    Source keys are made distinct before they travel: a key which fills a third of the source
    shrinks to one row per task.
    """
    wanted = source.select(*keys).distinct()
    return target.alias("t").join(wanted.alias("s"), F.expr(key_condition(keys)), "left_anti")


def soft_deletes(
    target: DataFrame, source: DataFrame, keys: Sequence[str], flag: str = DELETED
) -> DataFrame:
    """Active target rows missing in the source, now marked deleted."""
    return missing_in(active(target, flag), source, keys).withColumn(flag, F.lit(True))


def _joined(
    target: DataFrame, source: DataFrame, keys: Sequence[str], whole_target: bool, check_keys: bool
) -> DataFrame:
    """``t`` and ``s`` as structs, made behind the join: each column travels once, keys included."""
    t, s = _side(target, "t"), _side(unique_keys(source, keys) if check_keys else source, "s")
    same = reduce(and_, [F.col(f"_t_{k}") == F.col(f"_s_{k}") for k in keys])
    if whole_target:
        joined = t.join(s, same, "full_outer")
    else:
        # Only target rows with a partner matter. The semi join lets a small source be broadcast (or
        # sent as a runtime filter), so that the large target is scanned but not shuffled.
        wanted = source.select(*[F.col(k).alias(f"_s_{k}") for k in keys])
        joined = s.join(t.join(wanted, same, "left_semi"), same, "left_outer")
    rows = [
        F.when(F.col(f"_{name}"), F.struct(*[F.col(f"`_{name}_{c}`").alias(c) for c in df.columns])).alias(name)
        for name, df in (("t", target), ("s", source))
    ]
    return joined.select(*rows)


def _side(df: DataFrame, name: str) -> DataFrame:
    """The rows of one side of a join under names of their own, and a mark that they are there."""
    return df.select(*[F.col(f"`{c}`").alias(f"_{name}_{c}") for c in df.columns], F.lit(True).alias(f"_{name}"))


def _row(target: DataFrame, values: Setting | None, default: str | None) -> Column:
    """A struct of the target's columns, each from its setting, cast to the target's type."""
    fields = []
    for field in target.schema.fields:
        if values is not None and field.name in values:
            value = values[field.name]
            value = F.expr(value) if isinstance(value, str) else value
        else:
            value = F.col(f"{default}.`{field.name}`") if default else F.lit(None)
        fields.append(value.cast(field.dataType).alias(field.name))
    return F.struct(*fields)


def merge_pairs(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    update: Setting | None = None,
    when: str | Column | None = None,
    insert: Setting | None = None,
    insert_when: str | Column | None = None,
    whole_target: bool = True,
    check_keys: bool = True,
) -> DataFrame:
    """Pairs of a keyed merge.

    ``update`` and ``insert`` map target columns to expressions over ``t`` and ``s``; left out,
    they take every source column which the target also has. An empty mapping switches the branch
    off. ``when`` and ``insert_when`` limit the branches. With ``whole_target=False`` target rows
    without a partner are left out of the pairs. ``check_keys=False`` trusts the caller that source
    keys are unique and not NULL.
    """
    shared = {c: F.col(f"s.`{c}`") for c in source.columns if c in target.columns}
    update = shared if update is None else update
    insert = shared if insert is None else insert

    def condition(given: str | Column | None, branch: Setting) -> Column:
        if not branch:
            return F.lit(False)
        if given is None:
            return F.lit(True)
        return F.expr(given) if isinstance(given, str) else given

    in_target, in_source = F.col("t").isNotNull(), F.col("s").isNotNull()
    action = (
        F.when(in_target & in_source & condition(when, update), UPDATE)
        .when(~in_target & condition(insert_when, insert), INSERT)
        .otherwise(KEEP)
    )
    after = (
        F.when(F.col("action") == UPDATE, _row(target, update, "t"))
        .when(F.col("action") == INSERT, _row(target, insert, None))
        .otherwise(F.col("t"))
    )
    joined = _joined(target, source, keys, whole_target, check_keys)
    pairs = joined.withColumn("action", action)
    return pairs.select("t", "action", after.alias("after"))


def sync_pairs(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    flag: str = DELETED,
    null_safe: bool = True,
    grouped: bool = False,
) -> DataFrame:
    """Pairs that bring the target in line with a full extract.

    New keys are inserted, changed rows updated, active rows missing in the source marked deleted,
    and a deleted key which returns becomes active again, because its mark differs. A source ``grouped``
    by the keys holds each once; only NULL is looked for.
    """
    source = complete_keys(source, keys) if grouped else source
    source = source.withColumn(flag, F.lit(False))
    if set(source.columns) != set(target.columns):
        different = sorted(set(source.columns) ^ set(target.columns))
        raise ValueError(f"columns of only one of source and target: {different}")
    compared = [c for c in target.columns if c not in keys]
    in_target, in_source = F.col("t").isNotNull(), F.col("s").isNotNull()
    action = (
        F.when(~in_target, INSERT)
        .when(~in_source & ~F.col(f"t.`{flag}`"), SOFT_DELETE)
        .when(in_source & any_changed(compared, null_safe), UPDATE)
        .otherwise(KEEP)
    )
    incoming = _row(target, {c: F.col(f"s.`{c}`") for c in target.columns}, None)
    marked = _row(target, {flag: F.lit(True)}, "t")
    after = (
        F.when(F.col("action").isin(INSERT, UPDATE), incoming)
        .when(F.col("action") == SOFT_DELETE, marked)
        .otherwise(F.col("t"))
    )
    joined = _joined(target, source, keys, whole_target=True, check_keys=not grouped)
    pairs = joined.withColumn("action", action)
    return pairs.select("t", "action", after.alias("after"))


def merged_rows(pairs: DataFrame) -> DataFrame:
    """The table after the merge."""
    return pairs.where(F.col("after").isNotNull()).select("after.*")


def merge(target: DataFrame, source: DataFrame, keys: Sequence[str], **options) -> DataFrame:
    """The target after a keyed merge; options as for :func:`merge_pairs`."""
    return merged_rows(merge_pairs(target, source, keys, **options))


def sync(target: DataFrame, source: DataFrame, keys: Sequence[str], **options) -> DataFrame:
    """The target after a full synchronisation; options as for :func:`sync_pairs`."""
    return merged_rows(sync_pairs(target, source, keys, **options))
