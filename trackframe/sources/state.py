"""Stored metric state: raw sums and counts per (wave, segments), from which the metrics table derives.

The state lies next to the metrics table, partitioned by wave like the store it sums up. Each wave's
rows carry the settings they were aggregated under and an identity of the store files they were aggregated
from (names, sizes and times, from a listing), so a refresh knows which waves are out of date whatever wrote to the
store, re-aggregates only those, and derives the metrics from the small state. It costs the touched
waves, not the history.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession, functions as F

from trackframe.config import TrackerConfig
from trackframe.operators.features import add_features
from trackframe.operators.metrics import metric_parts, metrics_from_parts, wave_means
from trackframe.session import drop_path
from trackframe.sources.store import (
    RESPONDENT_COLUMNS,
    drop_partitions,
    in_partitions,
    in_table_order,
    literal_path,
    open_store,
    overwrite_table,
    partition_folders,
    write_partitioned,
)

SETTINGS, FILES = "__settings", "__files"


def state_path(metrics_path: str) -> str:
    return f"{metrics_path.rstrip('/')}_state"


def file_identities(spark: SparkSession, folders: dict, path: str) -> dict:
    """For each partition value of ``folders`` a number that changes whenever its data files do; reads no file."""
    if not folders:
        return {}
    listing = (spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option("basePath", path)
               .load([literal_path(f) for f in folders.values()]))
    one = F.xxhash64("path", "length", "modificationTime")
    rows = listing.groupBy(F.col("wave").cast("int")).agg(F.bit_xor(one).alias("files")).collect()
    return {r["wave"]: r["files"] for r in rows}


def read_state(spark: SparkSession, metrics_path: str) -> DataFrame | None:
    """The stored parts of all waves (see ``metric_parts``), or None if there are none."""
    state = open_store(spark, state_path(metrics_path))
    return None if state is None else state.drop(SETTINGS, FILES)


def refresh_metrics(spark: SparkSession, config: TrackerConfig, resp_path: str, metrics_path: str,
                    waves: Iterable | None = None) -> int:
    """Bring the metric state and the metrics table up to date with the store; returns the metrics' row count.

    Without ``waves`` the store's files are listed and every wave whose files changed since it was
    aggregated is read again. A writer that knows what it touched passes those ``waves``: they are
    read, and any the state lacks. Other settings than the state's mean that all waves are read. Waves gone from
    the store leave the state. Equal to aggregating the whole store.
    """
    path, settings = state_path(metrics_path), config.metric_fingerprint()
    folders = {None if v is None else int(v): f for v, f in partition_folders(spark, resp_path)}
    stored = open_store(spark, resp_path) if folders else None
    if stored is None:
        drop_path(spark, path)
        drop_path(spark, metrics_path)
        return 0
    state, known = open_store(spark, path), {}
    if state is not None:
        rows = state.groupBy("wave").agg(F.min(SETTINGS).alias("a"), F.max(SETTINGS).alias("b"), F.min(FILES).alias("files")).collect()
        if all(r["a"] == r["b"] == settings for r in rows):
            known = {r["wave"]: r["files"] for r in rows}
    if waves is None:
        identity = file_identities(spark, folders, resp_path)
        stale = [w for w in folders if w not in known or known[w] != identity.get(w)]
    else:
        touched = set(waves)
        stale = [w for w in folders if w in touched or w not in known]
        identity = file_identities(spark, {w: folders[w] for w in stale}, resp_path)
    if stale:
        files = spark.createDataFrame([(w, identity.get(w)) for w in stale], f"__wave int, {FILES} bigint")
        parts = metric_parts(stored.where(in_partitions(stale)), config)
        marked = parts.join(files, F.col("wave").eqNullSafe(F.col("__wave"))).drop("__wave").withColumn(SETTINGS, F.lit(settings))
        write_partitioned(marked, path, static=not known)
    drop_partitions(spark, path, [w for w in known if w not in folders])
    overwrite_table(metrics_from_parts(spark.read.parquet(path).drop(SETTINGS, FILES), config), metrics_path)
    return spark.read.parquet(metrics_path).count()


def read_respondents(spark: SparkSession, resp_path: str, metrics_path: str, config: TrackerConfig | None = None) -> DataFrame:
    """Stored respondents with all features.

    A store written without ``weight_norm`` gets it here, from the wave means of the metric state: a row
    that comes late changes the norms of its wave without a rewrite of the wave.
    """
    stored = open_store(spark, resp_path)
    if stored is None:
        raise FileNotFoundError(f"no respondents at {resp_path}")
    if "weight_norm" in stored.columns:
        return in_table_order(stored)
    state = read_state(spark, metrics_path)
    means = None if state is None else wave_means(state)
    bare = stored.drop("nps_segment", "top2box")
    return in_table_order(add_features(bare, config, means=means), RESPONDENT_COLUMNS)
