"""Key-based upsert (MERGE) into a partitioned parquet store, and duplicate-key handling.

MERGE semantics: a source row whose keys equal a target row's keys replaces
it, wherever in the store that row lies; other source rows are inserted; target rows the
source does not mention stay. Nulls never match, so a row with a null key is always inserted.

Only touched data are rewritten: the partitions the source writes to and, where the keys lack
the partition column, those that hold one of its keys (found by a semi join that reads key
columns only); or, with ``rewrite="files"``, just the files that hold one of its keys. The
source and the merged rows are staged as parquet in the shared folder, so the
write never reads the files it replaces, and a lost executor is recomputed
from the staged copy instead of from a half-overwritten store; the copies are
deleted once the write has committed. Everything an upsert decides on (touched
partitions, duplicate keys) is read from the staged copy. Joins carry no hints: the staged
copies have byte statistics, and Catalyst and AQE choose between broadcast and
shuffle from them. A failed job leaves the store untouched. The commit itself is not atomic: Spark's
dynamic overwrite deletes and then renames each touched partition, and folders or files whose rows have
all moved go last, so a driver crash inside that window can leave a partition without its old rows
(the staged merged copy then still holds the full intended content) or a moved row twice (the same
upsert again mends that).
"""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession, functions as F

from trackframe.session import drop_path, staged_copy
from trackframe.sources.store import (
    drop_partitions,
    in_partitions,
    in_table_order,
    literal_path,
    open_store,
    partition_folders,
    partition_values,
    write_partitioned,
)


class DuplicateKeyError(ValueError):
    """The source of an upsert holds the same key more than once."""


class SourceColumnsError(ValueError):
    """The columns of an upsert source are not those of the store."""


def whole_keys(keys: Sequence[str]) -> F.Column:
    """Condition: no key column is null."""
    whole = F.lit(True)
    for k in keys:
        whole = whole & F.col(k).isNotNull()
    return whole


def latest_per_key(df: DataFrame, keys: Sequence[str], order_col: str) -> DataFrame:
    """Keep, for every key, the row with the greatest ``order_col``; null keys group together.

    A row without an order value only wins where no row of the key has one.
    Ties go to the row with the greatest content hash, so the result does not
    depend on the partitioning. One aggregate with partial aggregation before the shuffle:
    a key repeated a million times still costs one row per task.
    """
    others = [c for c in df.columns if c not in keys]
    if not others:
        return df.distinct()
    rank = F.struct(F.col(order_col).isNotNull(), F.col(order_col), F.xxhash64(*others))
    agg = df.groupBy(*keys).agg(F.max_by(F.struct(*others), rank).alias("__row"))
    return agg.select(*keys, *[F.col(f"__row.{c}").alias(c) for c in others]).select(*df.columns)


def as_of(changes: DataFrame, keys: Sequence[str], change_col: str, upto=None) -> DataFrame:
    """State of a change table after all changes (or those up to ``upto``), without the change column.

    Every change row sets the row of its key; the latest change wins. One rule
    whatever the sizes: a row with a null in its key matches nothing and
    always stays, and a key set twice by one change keeps one of the two rows (by content hash).
    """
    if upto is not None:
        changes = changes.where(F.col(change_col) <= upto)
    whole = whole_keys(keys)
    latest = latest_per_key(changes.where(whole), keys, change_col)
    return latest.unionByName(changes.where(~whole)).drop(change_col)


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys occurring more than once, with their count."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies")).where(F.col("copies") > 1)


def check_duplicates(source: DataFrame, keys: Sequence[str], on_duplicate: str,
                     order_col: str | None) -> DataFrame:
    """Apply the duplicate-key policy to an upsert source.

    ``"error"`` raises ``DuplicateKeyError`` (keys with a null never match and
    are no duplicates); ``"latest"`` keeps the row with the greatest
    ``order_col`` per key, and every row with a null key; ``"allow"`` passes duplicates through.
    """
    if on_duplicate == "error":
        if not duplicate_keys(source.dropna(subset=list(keys)), keys).isEmpty():
            raise DuplicateKeyError(f"upsert source has duplicate keys on {list(keys)}")
        return source
    if on_duplicate == "latest":
        if order_col is None:
            raise ValueError("on_duplicate='latest' needs order_col")
        whole = whole_keys(keys)
        return latest_per_key(source.where(whole), keys, order_col).unionByName(source.where(~whole))
    if on_duplicate == "allow":
        return source
    raise ValueError("on_duplicate must be 'error', 'latest' or 'allow'")


def merge_frames(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Pure MERGE of two frames: target rows without a source match, then all source rows."""
    kept = target.join(source.select(*keys), list(keys), "left_anti")
    return kept.unionByName(source.select(*target.columns))


def _check_columns(stored: Sequence[str], given: Sequence[str], written: Sequence[str]) -> None:
    """An upsert sets every column of its rows: the store must have no others, and none may be new."""
    missing, new = [c for c in stored if c not in written], [c for c in given if c not in stored]
    if missing or new:
        raise SourceColumnsError(f"the upsert source lacks stored columns {missing} and has unknown columns {new}")


def _moved_from(stored: DataFrame, source: DataFrame, keys: Sequence[str], touched: list, partition_col: str) -> list:
    """Other partitions that hold one of the source's keys; reads the store's key columns only."""
    if partition_col in keys:
        return []
    elsewhere = stored.where(~F.coalesce(in_partitions(touched, partition_col), F.lit(False)))
    return partition_values(elsewhere.select(partition_col, *keys).join(source.select(*keys), list(keys), "left_semi"), partition_col)


def _one_form(path: str) -> str:
    """A path with one slash after its scheme, however many it came with."""
    return re.sub(r"^([A-Za-z0-9+.-]+):/+", r"\1:/", path)


def _replace_files(spark: SparkSession, stored: DataFrame, source: DataFrame, path: str, keys: Sequence[str], partition_col: str) -> list:
    """Write the source and what else the files with its keys hold as new files, then remove those; returns touched partition values."""
    located = stored.select(partition_col, *[k for k in keys if k != partition_col], F.col("_metadata.file_path").alias("__file"))
    hit = located.join(source.select(*keys), list(keys), "left_semi").select("__file").distinct()
    old = sorted(unquote(r["__file"]) for r in hit.collect())  # one path a file to be rewritten
    merged = source
    if old:
        held = spark.read.schema(stored.schema).option("basePath", path).parquet(*map(literal_path, old))
        merged = merge_frames(in_table_order(held, source.columns).select(*source.columns), source, keys)
    with staged_copy(merged, "merged") as staged:
        touched = partition_values(staged, partition_col)
        write_partitioned(staged, path, partition_col, mode="append")
        for file in old:
            drop_path(spark, file)
    emptied = {_one_form(f.rsplit("/", 1)[0]) for f in old}
    for _, folder in partition_folders(spark, path, partition_col):
        if _one_form(folder) in emptied and open_store(spark, literal_path(folder)) is None:
            drop_path(spark, folder)
    return touched


def merge_upsert(
    spark: SparkSession,
    source: DataFrame,
    path: str,
    keys: Sequence[str] = ("wave", "respondent_id"),
    partition_col: str = "wave",
    *,
    on_duplicate: str = "error",
    order_col: str | None = None,
    finish: Callable[[DataFrame], DataFrame] | None = None,
    rewrite: str = "partitions",
) -> list:
    """Upsert ``source`` into the store at ``path``; returns the touched partition values.

    The first write creates the store. Later writes match ``keys`` (any columns) over the whole store
    and rewrite only touched partitions, emptied ones included. The source must have the store's
    columns (``SourceColumnsError``). Duplicate source keys raise ``DuplicateKeyError`` unless
    ``on_duplicate`` is ``"latest"`` (greatest ``order_col`` wins) or ``"allow"``.
    ``finish`` adds derived columns to the merged rows of the touched
    partitions (all of them, so a feature may depend on its whole partition);
    the store then holds the source's columns and the derived ones.
    ``rewrite="files"`` replaces only files that hold a key of the source and writes all other rows
    as new files; it takes no ``finish``, as no partition is read whole.
    """
    if rewrite not in ("partitions", "files"):
        raise ValueError("rewrite must be 'partitions' or 'files'")
    if rewrite == "files" and finish is not None:
        raise ValueError("finish needs whole partitions; rewrite='files' does not read them")
    finish = finish or (lambda merged: merged)
    with staged_copy(source, "source") as staged:
        touched = partition_values(staged, partition_col)
        if not touched:
            return []
        checked = check_duplicates(staged, keys, on_duplicate, order_col)
        stored = open_store(spark, path)
        if stored is None:
            write_partitioned(finish(checked), path, partition_col)
            return touched
        _check_columns(stored.columns, source.columns, finish(checked).columns)
        if rewrite == "files":
            return _replace_files(spark, stored, checked, path, keys, partition_col)
        moved = _moved_from(stored, checked, keys, touched, partition_col)
        target = in_table_order(stored, source.columns).select(*source.columns).where(in_partitions([*touched, *moved], partition_col))
        # Staged before the overwrite: the write must not read the files it replaces.
        with staged_copy(merge_frames(target, checked, keys), "merged") as merged:
            left = set(partition_values(merged, partition_col)) if moved else set()
            write_partitioned(finish(merged), path, partition_col)
            # Dynamic overwrite leaves partitions without new rows as they are; those lost all theirs.
            drop_partitions(spark, path, [v for v in moved if v not in left], partition_col)
    return sorted({*touched, *moved} - {None}) + ([None] if None in (*touched, *moved) else [])
