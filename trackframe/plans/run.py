"""Full and incremental tracker runs: raw wave files -> respondent store -> metrics.

Flow of one run:

0. a content-free listing of the input files; with file tracking, an
   incremental run leaves out files it can prove it need not read again:
   unchanged, ingested under the same configuration, and all their waves stored;
1. header job and one tagged read of the raw CSVs, *staged once* as parquet
   under the shared folder, so later steps read only the columns
   they need instead of re-parsing the CSVs;
2. row counts and mean weights per wave from the staged copy, and the waves to process: those with clean
   rows, minus the stored waves in incremental mode;
3. features (those means joined back) and a
   dynamic-partition overwrite or a key upsert;
4. metrics: the waves whose files changed are aggregated into the stored metric state, from which the
   metrics derive, so they are current whatever wrote to the store and under whatever
   configuration (``sources.state``);
5. rejects, once their files' clean rows are stored: the rows of the files read replace those files'
   earlier rejects, so a wave whose rejects were fixed keeps none; last, the manifest of files.

Incremental runs process waves not yet stored; late rows for a stored wave
wait for a full run or for an upsert (``upsert_waves``).
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession, functions as F

from trackframe.config import TrackerConfig
from trackframe.operators.contract import CANONICAL_COLUMNS, REJECT_REASON
from trackframe.operators.features import add_features, row_features
from trackframe.operators.upsert import check_duplicates, merge_upsert
from trackframe.session import drop_path, staged_copy
from trackframe.sources.ingest import SOURCE_FILE, discover_wave_files, ingest_tagged, ingest_waves, list_wave_files, staged_headers
from trackframe.sources.state import refresh_metrics
from trackframe.sources.store import (
    MAX_PARTITIONS,
    TooManyPartitionsError,
    existing_waves,
    in_partitions,
    literal_path,
    open_store,
    replace_file_rows,
    write_partitioned,
)

RESPONDENT_KEYS = ("wave", "respondent_id")
WRITE_MODES = ("overwrite", "upsert")
# Where weight norms come from: a stored column, or the wave means of the metric state at read time.
NORMS = ("stored", "state")


@dataclass
class RunSummary:
    """Outcome of a run: its mode, the waves it wrote, and the rows of each output it produced."""

    mode: str
    waves_processed: list[int] = field(default_factory=list)
    clean_rows: int = 0
    reject_rows: int = 0
    metric_rows: int = 0

    def to_frame(self, spark: SparkSession) -> DataFrame:
        row = (self.mode, self.waves_processed, self.clean_rows, self.reject_rows, self.metric_rows)
        return spark.createDataFrame(
            [row], "mode string, waves_processed array<int>, clean_rows bigint, reject_rows bigint, metric_rows bigint")


def output_paths(output_dir: str) -> tuple[str, str, str]:
    base = output_dir.rstrip("/")
    return f"{base}/respondents", f"{base}/metrics", f"{base}/rejects"


def manifest_path(output_dir: str) -> str:
    """The raw files ingested into ``output_dir``: path, size, modification time, configuration, clean waves."""
    return f"{output_dir.rstrip('/')}/ingested_files"


FILE_KEYS = ["file_path", "file_size", "modified"]


def unread_files(spark: SparkSession, listing: DataFrame, output_dir: str, config: TrackerConfig, stored: list[int]) -> DataFrame:
    """Files of the listing that an incremental run has to read.

    Left out are files an earlier run ingested unchanged under the same
    configuration whose clean waves are all stored: reading them again could
    add no wave and would give the same rejects.
    """
    manifest = open_store(spark, manifest_path(output_dir))
    if manifest is None:
        return listing
    known = F.array(*[F.lit(w) for w in stored]).cast("array<int>")
    done = manifest.where((F.col("config") == config.fingerprint()) & (F.size(F.array_except("waves", known)) == 0))
    return listing.join(done.select(*FILE_KEYS).distinct(), FILE_KEYS, "left_anti")


def run_tracker(
    spark: SparkSession,
    config: TrackerConfig | None,
    input_path: str | list[str],
    output_dir: str,
    *,
    incremental: bool = False,
    write: str = "overwrite",
    replace: str = "partitions",
    recursive: bool = False,
    csv_options: dict | None = None,
    track_files: bool = True,
    norms: str = "stored",
) -> RunSummary:
    """Run the tracker over every wave file under ``input_path`` (a folder or a list of folders).

    ``write``: ``"overwrite"`` replaces the waves written; ``"upsert"`` merges
    rows by (wave, respondent_id), so stored respondents that are not in the input stay.
    ``replace="table"`` makes a full overwriting run drop stored waves that are
    no longer in the input, all of them if it holds no clean row; the default only replaces the waves it writes.
    ``norms="state"`` stores no ``weight_norm``: ``read_respondents`` adds it from the metric state, so
    that late rows of an upsert rewrite only the files that hold their keys.
    ``track_files`` keeps a manifest of ingested files next to the outputs, from which an
    incremental run knows files it need not read (see ``unread_files``).
    """
    if write not in WRITE_MODES:
        raise ValueError(f"write must be one of {WRITE_MODES}")
    if replace not in ("partitions", "table"):
        raise ValueError("replace must be 'partitions' or 'table'")
    if norms not in NORMS:
        raise ValueError(f"norms must be one of {NORMS}")
    anew = replace == "table" and write == "overwrite" and not incremental
    config = config or TrackerConfig()
    mode = "incremental" if incremental else "full"
    resp_path, metrics_path, reject_path = output_paths(output_dir)
    done = existing_waves(spark, resp_path) if incremental else []
    listing = list_wave_files(spark, input_path, recursive=recursive)
    if incremental and track_files:
        listing = unread_files(spark, listing, output_dir, config, done)

    # The listing once, as Spark's own file index holds it: what lands later belongs to the next run.
    listed = listing.select(*FILE_KEYS).toArrow()
    paths = [literal_path(p) for p in listed.column("file_path").to_pylist()]
    if not paths:
        if incremental:
            return RunSummary(mode, metric_rows=_rows(spark, metrics_path))
        if not discover_wave_files(spark, input_path, recursive=recursive):
            raise FileNotFoundError(f"no wave files found in {input_path!r}")
        # Nothing but empty files.
        return RunSummary(mode, metric_rows=_emptied(spark, config, resp_path, metrics_path) if anew else _rows(spark, metrics_path))
    files = spark.createDataFrame(listed)
    with staged_headers(spark, paths, pattern="") as headers:
        tagged = ingest_tagged(spark, paths, config, pattern="", keep_source=True, csv_options=csv_options, headers=headers)
        with staged_copy(tagged, "tagged") as staged:
            is_clean = F.col(REJECT_REASON).isNull()
            counts = staged.groupBy("wave").agg(F.count_if(is_clean).alias("clean"), F.count_if(~is_clean).alias("rejected"),
                                                F.avg(F.when(is_clean, F.col("weight"))).alias("mean"))
            by_wave = counts.limit(MAX_PARTITIONS + 1).collect()
            if len(by_wave) > MAX_PARTITIONS:
                raise TooManyPartitionsError(f"more than {MAX_PARTITIONS} waves; is the wave column mapped right?")
            clean_rows = {r["wave"]: r["clean"] for r in by_wave if r["clean"]}
            to_process = sorted(set(clean_rows) - set(done))
            rejected = sum(r["rejected"] for r in by_wave)

            if to_process:
                clean = staged.where(is_clean & in_partitions(to_process)).select(*CANONICAL_COLUMNS)
                if write == "upsert":
                    upsert_waves(spark, clean, resp_path, config, norms=norms)
                elif norms == "state":
                    write_partitioned(row_features(clean, config), resp_path, "wave", static=anew)
                else:  # whole waves are written, so the counts' means are theirs
                    means = spark.createDataFrame([(r["wave"], r["mean"]) for r in by_wave], "__wave int, __wave_mean double")
                    write_partitioned(add_features(clean, config, means=means), resp_path, "wave", static=anew)
            elif anew:
                drop_path(spark, resp_path)
            metric_rows = refresh_metrics(spark, config, resp_path, metrics_path)
            read = files.select(F.col("file_path").alias(SOURCE_FILE)) if incremental else None
            replace_file_rows(spark, staged.where(~is_clean), reject_path, read, SOURCE_FILE, none=not rejected)
            if track_files:
                seen = staged.groupBy(F.col(SOURCE_FILE).alias("file_path")).agg(
                    F.collect_set(F.when(is_clean, F.col("wave"))).alias("waves"), F.collect_set("wave").alias("all_waves"))
                _record_files(spark, files.join(seen, "file_path", "left"), output_dir, config, incremental)
            return RunSummary(mode, to_process, sum(clean_rows[w] for w in to_process), rejected, metric_rows)


def _emptied(spark: SparkSession, config: TrackerConfig, resp_path: str, metrics_path: str) -> int:
    """Remove the respondents and all that derives from them; returns the metric rows left (none)."""
    drop_path(spark, resp_path)
    return refresh_metrics(spark, config, resp_path, metrics_path)


def _rows(spark: SparkSession, path: str) -> int:
    stored = open_store(spark, path)
    return 0 if stored is None else stored.count()


def _record_files(spark: SparkSession, files: DataFrame, output_dir: str, config: TrackerConfig, incremental: bool) -> None:
    """After a run: add the files it read to the manifest (incremental) or replace the list (full)."""
    none = F.array().cast("array<int>")
    rows = files.select(*FILE_KEYS, F.lit(config.fingerprint()).alias("config"),
                        F.coalesce("waves", none).alias("waves"), F.coalesce("all_waves", none).alias("all_waves"))
    rows.coalesce(1).write.mode("append" if incremental else "overwrite").parquet(manifest_path(output_dir))


def files_of_waves(spark: SparkSession, input_path: str | list[str], output_dir: str, waves: list[int],
                   config: TrackerConfig | None = None, *, recursive: bool = False) -> DataFrame:
    """The listing without files known to hold no row of ``waves``.

    A file is known from the manifest of ``output_dir`` if it is unchanged and was read under the same
    configuration; any other file may hold anything and stays.
    """
    config = config or TrackerConfig()
    listing = list_wave_files(spark, input_path, recursive=recursive)
    manifest = open_store(spark, manifest_path(output_dir))
    if manifest is None or "all_waves" not in manifest.columns:
        return listing
    wanted = F.array(*[F.lit(w) for w in waves]).cast("array<int>")
    other = manifest.where((F.col("config") == config.fingerprint()) & ~F.arrays_overlap("all_waves", wanted))
    return listing.join(other.select(*FILE_KEYS).distinct(), FILE_KEYS, "left_anti")


def read_waves(spark: SparkSession, input_path: str | list[str], output_dir: str, waves: list[int], config: TrackerConfig | None = None,
               *, recursive: bool = False, **options) -> tuple[DataFrame, DataFrame]:
    """``(clean, rejects)`` of some waves, from the files that may hold them (``files_of_waves``)."""
    files = files_of_waves(spark, input_path, output_dir, waves, config, recursive=recursive)
    paths = [literal_path(r["file_path"]) for r in files.select("file_path").collect()]
    if not paths and discover_wave_files(spark, input_path, recursive=recursive):
        return ingest_waves(spark, input_path, config, only_waves=[], recursive=recursive, **options)
    return ingest_waves(spark, paths or input_path, config, only_waves=waves, pattern="" if paths else "*.csv", **options)


def upsert_waves(spark: SparkSession, new_clean: DataFrame, resp_path: str, config: TrackerConfig | None = None, *,
                 metrics_path: str | None = None, on_duplicate: str = "error", order_col: str | None = None, norms: str = "stored") -> list:
    """Merge clean canonical rows into the store by key, wave by wave; returns the touched waves.

    Unlike a plain key upsert, the within-wave weight normalisation of every
    touched wave is recomputed over the merged wave (stored rows + new rows),
    so a partial delivery of a wave leaves the same features as a full one. With ``norms="state"``
    the store holds no norms (see ``read_respondents``), and only files with a key of the new rows are rewritten.
    Duplicates are treated as in ``merge_upsert``; ``order_col`` need not be a column of the store. With ``metrics_path`` the
    metric state and the metrics table are brought up to date, reading only the touched waves; every run does that, too.
    """
    config = config or TrackerConfig()
    if norms not in NORMS:
        raise ValueError(f"norms must be one of {NORMS}")
    if on_duplicate == "latest":  # the order column decides here and is not stored
        new_clean, on_duplicate = check_duplicates(new_clean, RESPONDENT_KEYS, "latest", order_col), "allow"
    rows = new_clean.select(*CANONICAL_COLUMNS)
    if norms == "state":
        touched = merge_upsert(spark, row_features(rows, config), resp_path, RESPONDENT_KEYS, on_duplicate=on_duplicate, rewrite="files")
    else:
        touched = merge_upsert(spark, rows, resp_path, RESPONDENT_KEYS, on_duplicate=on_duplicate,
                               finish=lambda merged: add_features(merged.select(*CANONICAL_COLUMNS), config))
    if metrics_path and touched:
        refresh_metrics(spark, config, resp_path, metrics_path, touched)
    return touched


__all__ = ["RunSummary", "files_of_waves", "manifest_path", "output_paths", "read_waves", "refresh_metrics", "run_tracker", "upsert_waves"]
