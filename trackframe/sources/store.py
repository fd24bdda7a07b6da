"""Wave-partitioned parquet store: idempotent writes, listing, pending waves.

Respondents live under ``<path>/wave=<n>/``. Overwrites are *dynamic*: only
the partitions present in the written frame are replaced, so re-running a
wave never duplicates it and never disturbs other waves. The option is set per
write, so the session's own setting does not matter.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from trackframe.operators.contract import CANONICAL_COLUMNS
from trackframe.session import drop_path, hadoop_path, path_exists, staged_copy

FEATURE_COLUMNS = ["weight_norm", "nps_segment", "top2box"]
RESPONDENT_COLUMNS = CANONICAL_COLUMNS + FEATURE_COLUMNS

# More distinct partition values than this mean a mis-mapped column, not a tracker.
MAX_PARTITIONS = 100_000


class TooManyPartitionsError(ValueError):
    """A partition column holds implausibly many values; nothing was written."""


def partition_values(df: DataFrame, partition_col: str = "wave") -> list:
    """Distinct values of a partition column, ascending, a null last; at most ``MAX_PARTITIONS``."""
    rows = df.select(partition_col).distinct().limit(MAX_PARTITIONS + 1).collect()
    if len(rows) > MAX_PARTITIONS:
        raise TooManyPartitionsError(f"{partition_col} has more than {MAX_PARTITIONS} distinct values; is it the right column?")
    values = [r[0] for r in rows]
    return sorted(v for v in values if v is not None) + ([None] if None in values else [])


def in_partitions(values: Sequence, partition_col: str = "wave") -> F.Column:
    """Condition: the partition column is one of ``values`` (None matches null)."""
    known = F.col(partition_col).isin([v for v in values if v is not None])
    return known | F.col(partition_col).isNull() if None in values else known


def write_partitioned(
    df: DataFrame,
    path: str,
    partition_col: str | Sequence[str] = "wave",
    mode: str = "overwrite",
    *,
    rebalance: bool = True,
    static: bool = False,
    max_records_per_file: int | None = 5_000_000,
) -> None:
    """Write parquet partitioned by ``partition_col``; overwrite replaces only the partitions written.

    A REBALANCE on the partition columns comes first: rows of one partition
    meet in few tasks, so files are near the advisory size instead of one
    small file per task and partition, and AQE splits a hot partition over
    several tasks. ``static`` replaces the whole table instead.
    """
    cols = [partition_col] if isinstance(partition_col, str) else list(partition_col)
    if rebalance:
        df = df.hint("rebalance", *cols)
    writer = df.write.mode(mode).option("partitionOverwriteMode", "static" if static else "dynamic").partitionBy(*cols)
    if max_records_per_file:
        writer = writer.option("maxRecordsPerFile", max_records_per_file)
    writer.parquet(path)


def overwrite_table(df: DataFrame, path: str) -> None:
    """Replace an unpartitioned table wholesale (the small metrics table)."""
    df.write.mode("overwrite").parquet(path)


def open_store(spark: SparkSession, path: str) -> DataFrame | None:
    """The dataset at ``path`` (listed and its schema resolved once), or None if there is none."""
    if not path_exists(spark, path):
        return None
    try:
        return spark.read.parquet(path)
    except AnalysisException as e:
        # A folder without data files is no dataset; anything else must not pass for one.
        if e.getCondition() in ("UNABLE_TO_INFER_SCHEMA", "PATH_NOT_FOUND"):
            return None
        raise


def store_exists(spark: SparkSession, path: str) -> bool:
    """True when ``path`` holds a readable parquet dataset."""
    return open_store(spark, path) is not None


def in_table_order(df: DataFrame, column_order: Sequence[str] = RESPONDENT_COLUMNS) -> DataFrame:
    """``df`` with the columns named in ``column_order`` first, in that order."""
    first = [c for c in column_order if c in df.columns]
    return df.select(*first, *[c for c in df.columns if c not in first])


def read_store(spark: SparkSession, path: str, column_order: Sequence[str] = RESPONDENT_COLUMNS) -> DataFrame:
    """Read a partitioned store with its columns back in table order (partition discovery puts that column last)."""
    return in_table_order(spark.read.parquet(path), column_order)


# Fixed value: the folder name Spark gives a null partition value.
NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"
# Levels of nested partition folders that are searched for a partition column.
DEEPEST = 8


def literal_path(path: str) -> str:
    """A file's path with glob characters escaped, so that a reader takes it literally."""
    return re.sub(r"([\\\[\]{}*?])", r"\\\1", path)


def partition_folders(spark: SparkSession, path: str, partition_col: str = "wave") -> list[tuple[str | None, str]]:
    """``(value, folder)`` of every partition folder of the column, from folder names alone; no data file is opened.

    One listing by the path's own file system a level, handed over as one string. Values are
    text as written, a null partition None. A column of an inner level comes once
    a folder.
    """
    root, fs = hadoop_path(spark, path)
    if not fs.exists(root):
        return []
    jvm, base = spark.sparkContext._jvm, fs.getFileStatus(root).getPath().toString().rstrip("/")
    for depth in range(DEEPEST):
        pattern = jvm.org.apache.hadoop.fs.Path("/".join([literal_path(base), *["*=*"] * (depth + 1)]))
        listed = jvm.org.apache.commons.lang3.ArrayUtils.toString(jvm.org.apache.hadoop.fs.FileUtil.stat2Paths(fs.globStatus(pattern)))[1:-1]
        # Spark escapes "/" in partition values, so the root's path marks where each entry begins.
        folders = re.split(",(?=" + re.escape(base) + "/)", listed) if listed else []
        if not folders:
            return []
        names = [(f, f.rsplit("/", 1)[-1].partition("=")) for f in folders]
        found = [(None if value == NULL_PARTITION else unquote(value), f) for f, (name, _, value) in names if unquote(name) == partition_col]
        if found:
            return sorted(found, key=lambda x: (x[0] is None, x))
    return []


def stored_values(spark: SparkSession, path: str, partition_col: str = "wave") -> list:
    """Distinct values of a partition column from its folders: ints if all are, else text; ascending, a null last."""
    found = {v for v, _ in partition_folders(spark, path, partition_col)}
    if len(found) > MAX_PARTITIONS:
        raise TooManyPartitionsError(f"{partition_col} has more than {MAX_PARTITIONS} distinct values; is it the right column?")
    known = [v for v in found if v is not None]
    if all(re.fullmatch(r"-?\d+", v) for v in known):
        known = [int(v) for v in known]
    return sorted(known) + ([None] if None in found else [])


def stored_waves(spark: SparkSession, path: str, partition_col: str = "wave") -> DataFrame:
    """Distinct stored partition values as a one-column frame (empty if no store), from folder names alone."""
    values = stored_values(spark, path, partition_col)
    known = [v for v in values if v is not None]
    kind = "int" if all(isinstance(v, int) and abs(v) < 1 << 31 for v in known) else "bigint" if all(isinstance(v, int) for v in known) else "string"
    return spark.createDataFrame([(v,) for v in values], f"`{partition_col}` {kind}")


def existing_waves(spark: SparkSession, path: str, partition_col: str = "wave") -> list[int]:
    """Sorted stored partition values; bounded by ``MAX_PARTITIONS``."""
    return [int(v) for v in stored_values(spark, path, partition_col) if v is not None]


def drop_partitions(spark: SparkSession, path: str, values: Sequence, partition_col: str = "wave") -> None:
    """Remove the partition folders of these values (None is the null partition)."""
    gone = {None if v is None else str(v) for v in values}
    for value, folder in partition_folders(spark, path, partition_col) if gone else []:
        if value in gone:
            drop_path(spark, folder)


def pending_waves(available: DataFrame, stored: DataFrame, wave_col: str = "wave") -> DataFrame:
    """Waves present in ``available`` and not yet in ``stored`` (left anti join)."""
    return (available.select(wave_col).where(F.col(wave_col).isNotNull()).distinct()
            .join(stored.select(wave_col), wave_col, "left_anti"))


# Buckets of a side table: a re-read file rewrites about one of so many parts of it.
BUCKETS = 64
BUCKET = "bucket"


def _bucket(file_col: str) -> F.Column:
    return F.pmod(F.xxhash64(file_col), F.lit(BUCKETS)).cast("int")


def replace_file_rows(spark: SparkSession, new: DataFrame, path: str, files: DataFrame | None, file_col: str,
                      partition_col: str = "wave", *, none: bool | None = None) -> None:
    """Replace a side table's rows of the read ``files`` by ``new``; with ``files`` None, all rows.

    A caller that has counted ``new`` says whether there are ``none``.

    The table is partitioned by a bucket of the file's hash, then by ``partition_col``. Only buckets that
    one of the files falls in are read and rewritten (from a staged copy, so rows that are gone leave no
    stale partition behind); the files of other buckets stay as they are. Without any row the table goes.
    """
    layout = [BUCKET, partition_col]
    rows = new.withColumn(BUCKET, _bucket(file_col))
    stored = open_store(spark, path) if files is not None else None
    if stored is None:
        if new.isEmpty() if none is None else none:
            drop_path(spark, path)
        else:
            write_partitioned(rows, path, layout, static=True)
        return
    if file_col not in stored.columns:
        raise ValueError(f"the table at {path} does not tell which files its rows come from ({file_col})")
    whole = BUCKET not in stored.columns  # a table of another layout is rewritten once
    touched = [r[0] for r in files.select(_bucket(file_col)).distinct().collect()]  # at most BUCKETS
    kept = stored if whole else stored.where(F.col(BUCKET).isin(touched))
    kept = kept.join(files.select(file_col), file_col, "left_anti").select(*[F.col(f.name).cast(f.dataType) for f in new.schema])
    with staged_copy(kept.withColumn(BUCKET, _bucket(file_col)).unionByName(rows), "side") as staged:
        left = {(str(b), None if v is None else str(v)) for b, v in staged.select(*layout).distinct().collect()}
        if left:
            write_partitioned(staged, path, layout, static=whole)
    if whole:
        if not left:
            drop_path(spark, path)
        return
    folders = partition_folders(spark, path, partition_col)
    gone = [f for v, f in folders if (b := f.rsplit("/", 2)[1].partition("=")[2]) in map(str, touched) and (b, v) not in left]
    for folder in gone:
        drop_path(spark, folder)
    if len(gone) == len(folders):
        drop_path(spark, path)
