"""The query catalogue: every operator as a (Spark plan, DuckDB oracle) pair.

Each Spark query takes ``(spark, sf_dir)`` and reads the driver's parquet
tables, or files Spark derives from them and stages under the shared folder.
``ORACLE_SQL`` holds DuckDB text computing the same rows from the same tables.
Every float is rounded identically on both sides and every column aliased.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession, functions as F

from trackframe.config import TrackerConfig
from trackframe.functions.expressions import net_score, nps_segment, top_box, weighted_share
from trackframe.operators.contract import CANONICAL_COLUMNS, REJECT_REASON, enforce_contract, tag_rows
from trackframe.operators.features import add_features, normalise_weights
from trackframe.operators.harmonise import harmonise, recode_lookup
from trackframe.operators.metrics import (
    add_parts,
    metric_parts,
    metrics_from_parts,
    refresh_wave_metrics,
    wave_metrics,
    wave_metrics_direct,
)
from trackframe.operators.upsert import as_of, duplicate_keys, latest_per_key, merge_upsert
from trackframe.plans import oracle as sql
from trackframe.plans.fixtures import (
    DRIFT_CONFIG,
    REGION_CODES,
    drifted_waves_folder,
    many_headers_folder,
    stage_canonical_waves,
    true_wave,
    write_csv,
)
from trackframe.plans.run import RESPONDENT_KEYS, output_paths, read_waves, run_tracker, upsert_waves
from trackframe.plans.views import document_flags, events_tracker, orders_tracker, orders_tracker_raw, table
from trackframe.session import scratch_path, staged_copy
from trackframe.sources.ingest import SOURCE_FILE, ingest_tagged, ingest_waves
from trackframe.sources.state import read_respondents
from trackframe.sources.store import existing_waves, pending_waves, read_store, store_exists, stored_waves, write_partitioned
from trackframe.streaming.waves import stream_waves

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        if oracle is not None:
            ORACLE_SQL[name] = oracle
        return fn
    return deco


CFG = TrackerConfig()
TRACKER, RAW = sql.ORDERS_TRACKER, sql.ORDERS_TRACKER_RAW_TYPED
FEATURES = sql.features(TRACKER)
CLEAN_FEATURES = sql.features(sql.clean(RAW))
P5 = ["wave", "region", "n", "nps", "nps_delta", "top2box_pct", "awareness_pct", "nps_rank_in_wave"]


def _features_out(df: DataFrame) -> DataFrame:
    return df.select(*CANONICAL_COLUMNS, F.round("weight_norm", 6).alias("weight_norm"), "nps_segment", "top2box")


def _metrics(spark, sf_dir, cfg=CFG) -> DataFrame:
    """Tracker metrics over the orders adapter, in one aggregation pass over raw weights."""
    return wave_metrics_direct(orders_tracker(spark, sf_dir), cfg)


# ---------------------------------------------------------------- metrics

@register("wave_metrics", sql.metrics(FEATURES, ["region"]))
def q_wave_metrics(spark, sf_dir):
    """Flagship: weighted NPS / top-box / awareness by wave x region, with delta and rank, in one pass."""
    return _metrics(spark, sf_dir)


@register("wave_metrics_features", sql.metrics(FEATURES, ["region"]))
def q_wave_metrics_features(spark, sf_dir):
    """The flagship through row-level features (per-wave means joined back), as stored respondents have them."""
    return wave_metrics(add_features(orders_tracker(spark, sf_dir)))


@register("wave_metrics_window_norm", sql.metrics(FEATURES, ["region"]))
def q_wave_metrics_window_norm(spark, sf_dir):
    """The flagship over a written respondent store: norms within each wave, then aggregates."""
    path = scratch_path(spark, "store")
    write_partitioned(add_features(orders_tracker(spark, sf_dir)), path)
    return wave_metrics(read_store(spark, path))


@register("wave_metrics_by_age", sql.metrics(FEATURES, ["age_group"]))
def q_wave_metrics_by_age(spark, sf_dir):
    return _metrics(spark, sf_dir, CFG.with_segments("age_group"))


@register("wave_metrics_region_age", sql.metrics(FEATURES, ["region", "age_group"]))
def q_wave_metrics_region_age(spark, sf_dir):
    return _metrics(spark, sf_dir, CFG.with_segments("region", "age_group"))


@register("wave_metrics_overall", sql.metrics(FEATURES, []))
def q_wave_metrics_overall(spark, sf_dir):
    """No segment: one row per wave, delta over all waves, no rank column."""
    return _metrics(spark, sf_dir, CFG.with_segments())


@register("wave_metrics_thresholds",
          sql.metrics(sql.features(TRACKER, 8, 5, 5), ["brand_used"]))
def q_wave_metrics_thresholds(spark, sf_dir):
    """Custom promoter / detractor / top-box thresholds, segmented by brand."""
    cfg = TrackerConfig(segment_cols=("brand_used",), promoter_min=8, detractor_max=5, top2box_min=5)
    return _metrics(spark, sf_dir, cfg)


@register("wave_metrics_zero_fill", sql.metrics(FEATURES, ["region", "brand_used"], zero_fill=True))
def q_wave_metrics_zero_fill(spark, sf_dir):
    cfg = TrackerConfig(segment_cols=("region", "brand_used"), zero_fill=True)
    return _metrics(spark, sf_dir, cfg)


@register("wave_metrics_events", sql.metrics(sql.features(sql.EVENTS_TRACKER), ["event_type"]))
def q_wave_metrics_events(spark, sf_dir):
    """Events as a 30-wave tracker (day of month), segmented by event type."""
    return wave_metrics_direct(events_tracker(spark, sf_dir), CFG.with_segments("event_type"))


@register("wave_metrics_from_raw", sql.metrics(CLEAN_FEATURES, ["region"]))
def q_wave_metrics_from_raw(spark, sf_dir):
    """Dirty text rows -> contract -> features -> metrics, without files."""
    clean, _ = enforce_contract(orders_tracker_raw(spark, sf_dir))
    return wave_metrics_direct(clean, CFG)


@register("metrics_report", f"SELECT {', '.join(P5)} FROM ({sql.metrics(FEATURES, ['region'])}) "
                            "ORDER BY wave, region")
def q_metrics_report(spark, sf_dir):
    """The report view: headline columns ordered by wave and region."""
    return _metrics(spark, sf_dir).select(*P5).orderBy("wave", "region")


@register("weight_norm", f"SELECT respondent_id, wave, round(weight_norm, 6) AS weight_norm FROM ({FEATURES})")
def q_weight_norm(spark, sf_dir):
    """W1 straight from the tables."""
    out = normalise_weights(orders_tracker(spark, sf_dir))
    return out.select("respondent_id", "wave", F.round("weight_norm", 6).alias("weight_norm"))


@register("weight_norm_window", f"SELECT respondent_id, wave, round(weight_norm, 6) AS weight_norm FROM ({FEATURES})")
def q_weight_norm_window(spark, sf_dir):
    """W1 over a stored input, whose plan is cheap to read for the means and again for the rows."""
    path = scratch_path(spark, "store")
    write_partitioned(orders_tracker(spark, sf_dir), path)
    out = normalise_weights(read_store(spark, path, CANONICAL_COLUMNS))
    return out.select("respondent_id", "wave", F.round("weight_norm", 6).alias("weight_norm"))


@register("nps_segment_counts",
          f"SELECT wave, nps_segment, count(*) AS n FROM ({FEATURES}) GROUP BY wave, nps_segment")
def q_nps_segment_counts(spark, sf_dir):
    segment = nps_segment(F.col("nps_score")).alias("nps_segment")
    return orders_tracker(spark, sf_dir).groupBy("wave", segment).agg(F.count(F.lit(1)).alias("n"))


@register("top2box_counts", f"SELECT wave, top2box, count(*) AS n FROM ({FEATURES}) GROUP BY wave, top2box")
def q_top2box_counts(spark, sf_dir):
    flag = top_box(F.col("satisfaction")).alias("top2box")
    return orders_tracker(spark, sf_dir).groupBy("wave", flag).agg(F.count(F.lit(1)).alias("n"))


@register("nps_delta", f"SELECT wave, region, nps, nps_delta FROM ({sql.metrics(FEATURES, ['region'])})")
def q_nps_delta(spark, sf_dir):
    return _metrics(spark, sf_dir).select("wave", "region", "nps", "nps_delta")


_GAP = f"SELECT * FROM ({TRACKER}) WHERE NOT (wave = 4 AND region = 'ASIA')"


def _gap_metrics(spark, sf_dir, cfg):
    t = orders_tracker(spark, sf_dir).where(~((F.col("wave") == 4) & (F.col("region") == "ASIA")))
    return wave_metrics_direct(t, cfg).select("wave", "region", "nps", "nps_delta")


@register("nps_delta_gap", f"SELECT wave, region, nps, nps_delta FROM ({sql.metrics(sql.features(_GAP), ['region'])})")
def q_nps_delta_gap(spark, sf_dir):
    """ASIA has no wave 4: its wave-5 delta is taken against wave 3."""
    return _gap_metrics(spark, sf_dir, CFG)


@register("nps_delta_strict",
          f"SELECT wave, region, nps, nps_delta FROM "
          f"({sql.metrics(sql.features(_GAP), ['region'], strict_previous=True)})")
def q_nps_delta_strict(spark, sf_dir):
    """As ``nps_delta_gap`` but only compared with the directly preceding wave."""
    return _gap_metrics(spark, sf_dir, TrackerConfig(strict_previous=True))


@register("nps_rank", f"SELECT wave, region, nps, nps_rank_in_wave FROM ({sql.metrics(FEATURES, ['region'])})")
def q_nps_rank(spark, sf_dir):
    return _metrics(spark, sf_dir).select("wave", "region", "nps", "nps_rank_in_wave")


# ---------------------------------------------------------------- weighted shares on other tables

@register("weighted_share_labels", f"""
SELECT lang, count(*) AS n, {sql.share('quality', 'weight')} AS quality_pct,
       {sql.share('toxic', 'weight')} AS toxic_pct
FROM ({sql.DOCUMENT_FLAGS}) GROUP BY lang""")
def q_weighted_share_labels(spark, sf_dir):
    """Length-weighted share of quality and toxic documents per language."""
    w = F.col("weight")
    return document_flags(spark, sf_dir).groupBy("lang").agg(
        F.count(F.lit(1)).alias("n"),
        weighted_share(F.col("quality"), w).alias("quality_pct"),
        weighted_share(F.col("toxic"), w).alias("toxic_pct"))


@register("weighted_net_score", f"""
SELECT source, count(*) AS n,
       CASE WHEN sum(weight) FILTER (WHERE quality IS NOT NULL AND toxic IS NOT NULL) > 0 THEN
         round((sum(weight) FILTER (WHERE quality = 1 AND toxic = 0) - sum(weight) FILTER (WHERE toxic = 1))
               / sum(weight) FILTER (WHERE quality IS NOT NULL AND toxic IS NOT NULL) * 100, 1) END AS net_score
FROM ({sql.DOCUMENT_FLAGS}) GROUP BY source""")
def q_weighted_net_score(spark, sf_dir):
    """Net score (good minus toxic, length-weighted) per document source."""
    q, t = F.col("quality"), F.col("toxic")
    return document_flags(spark, sf_dir).groupBy("source").agg(
        F.count(F.lit(1)).alias("n"),
        net_score((q == 1) & (t == 0), t == 1, q.isNotNull() & t.isNotNull(), F.col("weight")).alias("net_score"))


# ---------------------------------------------------------------- contract

@register("contract_clean", sql.clean(RAW))
def q_contract_clean(spark, sf_dir):
    return enforce_contract(orders_tracker_raw(spark, sf_dir))[0]


@register("contract_rejects", sql.rejects(RAW))
def q_contract_rejects(spark, sf_dir):
    return enforce_contract(orders_tracker_raw(spark, sf_dir))[1]


@register("reject_reason_counts",
          f"SELECT reject_reason, count(*) AS n FROM ({sql.rejects(RAW)}) GROUP BY reject_reason")
def q_reject_reason_counts(spark, sf_dir):
    _, rejects = enforce_contract(orders_tracker_raw(spark, sf_dir))
    return rejects.groupBy(REJECT_REASON).agg(F.count(F.lit(1)).alias("n"))


_STRICT = f"""
SELECT CASE WHEN respondent_id IS NULL THEN 'missing respondent_id'
            WHEN wave IS NULL THEN 'missing wave'
            WHEN {sql.KEY} % 71 = 0 THEN 'satisfaction not parseable'
            ELSE reject_reason END AS reject_reason
FROM ({sql.tagged(f"SELECT * REPLACE (CASE WHEN {sql.KEY} % 71 = 0 THEN NULL ELSE satisfaction END AS satisfaction) FROM ({RAW})")})
"""


@register("contract_strict_parse",
          f"SELECT reject_reason, count(*) AS n FROM ({_STRICT}) WHERE reject_reason IS NOT NULL GROUP BY reject_reason")
def q_contract_strict_parse(spark, sf_dir):
    """Strict parsing: unparseable satisfaction text becomes a reject, after the key rules."""
    raw = orders_tracker_raw(spark, sf_dir)
    key = F.col("respondent_id").cast("bigint")
    raw = raw.withColumn("satisfaction", F.when(key % 71 == 0, F.lit("n/a")).otherwise(F.col("satisfaction")))
    tagged = tag_rows(raw, strict_parse=True)
    return (tagged.where(F.col(REJECT_REASON).isNotNull())
            .groupBy(REJECT_REASON).agg(F.count(F.lit(1)).alias("n")))


# ---------------------------------------------------------------- harmonise (H1-H3)

@register("harmonise_rename", f"SELECT respondent_id, wave, nps_score, region, age_group FROM ({TRACKER})")
def q_harmonise_rename(spark, sf_dir):
    """Chained renames (nps -> score_raw -> nps_score), a plain rename, and a guarded collision."""
    legacy = orders_tracker(spark, sf_dir).select(
        "respondent_id", "wave", F.col("nps_score").alias("nps"), F.col("region").alias("region_code"), "age_group")
    rename = {"nps": "score_raw", "score_raw": "nps_score", "region_code": "region", "age_group": "wave"}
    return harmonise(legacy, rename).select("respondent_id", "wave", "nps_score", "region", "age_group")


_CODE_CASE = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in REGION_CODES.items())


@register("harmonise_recode", f"""
SELECT wave, CASE region {_CODE_CASE} ELSE region END AS region,
       CASE age_group WHEN '1-URGENT' THEN 'P1' WHEN '2-HIGH' THEN 'P2' ELSE age_group END AS age_group,
       count(*) AS n
FROM ({TRACKER}) GROUP BY ALL""")
def q_harmonise_recode(spark, sf_dir):
    """Value recodes on two columns; unmapped values pass through."""
    out = harmonise(orders_tracker(spark, sf_dir), region_map=REGION_CODES,
                    recode_maps={"age_group": {"1-URGENT": "P1", "2-HIGH": "P2"}})
    return out.groupBy("wave", "region", "age_group").agg(F.count(F.lit(1)).alias("n"))


@register("harmonise_trim", f"SELECT respondent_id, region, age_group, brand_used FROM ({TRACKER})")
def q_harmonise_trim(spark, sf_dir):
    t = orders_tracker(spark, sf_dir)
    padded = t.select("respondent_id", F.concat(F.lit("  "), "region", F.lit(" ")).alias("region"),
                      F.concat(F.lit(" "), "age_group").alias("age_group"),
                      F.concat("brand_used", F.lit("   ")).alias("brand_used"))
    return harmonise(padded).select("respondent_id", "region", "age_group", "brand_used")


# ---------------------------------------------------------------- file ingest

@register("ingest_drifted_waves", sql.clean(sql.DRIFT_TYPED))
def q_ingest_drifted_waves(spark, sf_dir):
    """Three header dialects in one folder: renamed, recoded, reordered, missing and extra columns."""
    folder = drifted_waves_folder(spark, sf_dir)
    return ingest_waves(spark, folder, DRIFT_CONFIG, recursive=True)[0]


@register("ingest_rejects", sql.rejects(sql.DRIFT_TYPED))
def q_ingest_rejects(spark, sf_dir):
    folder = drifted_waves_folder(spark, sf_dir)
    return ingest_waves(spark, folder, DRIFT_CONFIG, recursive=True)[1]


@register("ingest_many_files", sql.clean(sql.DRIFT_TYPED))
def q_ingest_many_files(spark, sf_dir):
    """The drifted waves delivered as 64 files per header: one header job, three CSV scans."""
    folder = drifted_waves_folder(spark, sf_dir, files_per_group=64)
    return ingest_waves(spark, folder, DRIFT_CONFIG, recursive=True)[0]


@register("only_waves", f"SELECT * FROM ({sql.clean(sql.DRIFT_TYPED)}) WHERE wave IN (2, 3, 4)")
def q_only_waves(spark, sf_dir):
    folder = drifted_waves_folder(spark, sf_dir)
    return ingest_waves(spark, folder, DRIFT_CONFIG, only_waves=[2, 3, 4], recursive=True)[0]


# ---------------------------------------------------------------- partitioned store

@register("partition_roundtrip", f"SELECT {sql.FEATURE_OUT} FROM ({FEATURES})")
def q_partition_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "store")
    write_partitioned(add_features(orders_tracker(spark, sf_dir)), path)
    return _features_out(read_store(spark, path))


@register("idempotent_rerun", f"SELECT {sql.FEATURE_OUT} FROM ({FEATURES})")
def q_idempotent_rerun(spark, sf_dir):
    """Writing the same waves twice leaves one copy (dynamic partition overwrite)."""
    path = scratch_path(spark, "store")
    for _ in range(2):
        write_partitioned(add_features(orders_tracker(spark, sf_dir)), path)
    return _features_out(read_store(spark, path))


@register("stored_waves", f"SELECT DISTINCT wave FROM ({TRACKER})")
def q_stored_waves(spark, sf_dir):
    path = scratch_path(spark, "store")
    write_partitioned(orders_tracker(spark, sf_dir), path)
    return stored_waves(spark, path)


@register("pending_waves", f"SELECT DISTINCT wave FROM ({TRACKER}) WHERE wave > 3")
def q_pending_waves(spark, sf_dir):
    path = scratch_path(spark, "store")
    tracker = orders_tracker(spark, sf_dir)
    write_partitioned(tracker.where("wave <= 3"), path)
    return pending_waves(tracker, stored_waves(spark, path))


def _incremental_run(spark, sf_dir):
    """A full run over the first drop (waves 1-3), then an incremental run once the second lands."""
    out = f"{scratch_path(spark, 'run')}/out"
    first = drifted_waves_folder(spark, sf_dir, [1, 2, 3])
    second = drifted_waves_folder(spark, sf_dir, [4, 5, 6, 7])
    run_tracker(spark, DRIFT_CONFIG, first, out, recursive=True)
    summary = run_tracker(spark, DRIFT_CONFIG, [first, second], out, incremental=True, recursive=True)
    return summary, out


@register("incremental_run_metrics", sql.metrics(sql.features(sql.clean(sql.DRIFT_TYPED)), ["region"]))
def q_incremental_run_metrics(spark, sf_dir):
    """Full run over waves 1-3, incremental run after waves 4-7 land; the metrics table."""
    _, out = _incremental_run(spark, sf_dir)
    return spark.read.parquet(output_paths(out)[1])


@register("run_summary", f"""
SELECT 'incremental' AS mode,
       CAST(count(DISTINCT wave) FILTER (WHERE reject_reason IS NULL AND wave >= 4) AS INTEGER) AS waves_processed,
       CAST(min(wave) FILTER (WHERE reject_reason IS NULL AND wave >= 4) AS INTEGER) AS first_wave,
       CAST(max(wave) FILTER (WHERE reject_reason IS NULL AND wave >= 4) AS INTEGER) AS last_wave,
       count(*) FILTER (WHERE reject_reason IS NULL AND wave >= 4) AS clean_rows,
       count(*) FILTER (WHERE reject_reason IS NOT NULL AND (wave >= 4 OR
                        (wave IS NULL AND CAST(substr(fieldwork_date, 1, 4) AS INTEGER) - 1994 >= 4)))
         AS reject_rows,
       (SELECT count(*) FROM (SELECT DISTINCT wave, region FROM ({sql.clean(sql.DRIFT_TYPED)}))) AS metric_rows
FROM ({sql.tagged(sql.DRIFT_TYPED)})""")
def q_run_summary(spark, sf_dir):
    """The incremental run's summary (true mode, processed waves, observed counts).

    The incremental run reads only the second drop's files (waves 4-7), so its
    rejects are those of the new waves plus the wave-less rows of those files.
    """
    s, _ = _incremental_run(spark, sf_dir)
    return spark.createDataFrame(
        [(s.mode, len(s.waves_processed), min(s.waves_processed), max(s.waves_processed),
          s.clean_rows, s.reject_rows, s.metric_rows)],
        "mode string, waves_processed int, first_wave int, last_wave int, clean_rows bigint, "
        "reject_rows bigint, metric_rows bigint")


@register("rejects_store", sql.rejects(sql.DRIFT_TYPED))
def q_rejects_store(spark, sf_dir):
    """The wave-partitioned reject side output of a full run (null wave in its own partition)."""
    root = scratch_path(spark, "run")
    run_tracker(spark, DRIFT_CONFIG, drifted_waves_folder(spark, sf_dir), f"{root}/out", recursive=True)
    return spark.read.parquet(output_paths(f"{root}/out")[2]).select(*CANONICAL_COLUMNS, REJECT_REASON)


# ---------------------------------------------------------------- re-runs, lineage, odd files

@register("source_file_counts", f"""
SELECT CASE w WHEN 1 THEN 'legacy' WHEN 2 THEN 'renamed' WHEN 3 THEN 'renamed' WHEN 4 THEN 'renamed' ELSE 'extra' END AS delivery,
       count(*) AS n FROM (SELECT CAST(substr(fieldwork_date, 1, 4) AS INTEGER) - 1994 AS w FROM ({sql.DRIFT_TYPED})) GROUP BY ALL""")
def q_source_file_counts(spark, sf_dir):
    """Lineage: every ingested row knows its file; rows by the folder it came from."""
    tagged = ingest_tagged(spark, drifted_waves_folder(spark, sf_dir), DRIFT_CONFIG, recursive=True, keep_source=True)
    folder = F.element_at(F.split(SOURCE_FILE, "/"), -2)
    return tagged.groupBy(folder.alias("delivery")).agg(F.count(F.lit(1)).alias("n"))


@register("stored_waves_after_upsert", f"SELECT DISTINCT wave FROM ({TRACKER})")
def q_stored_waves_after_upsert(spark, sf_dir):
    """Stored waves of a store that grew by a key upsert."""
    base, source = _upsert_frames(spark, sf_dir)
    path = scratch_path(spark, "store")
    merge_upsert(spark, base, path)
    merge_upsert(spark, source, path)
    return stored_waves(spark, path)


@register("ingest_odd_names", sql.clean(sql.DRIFT_TYPED))
def q_ingest_odd_names(spark, sf_dir):
    """The drifted waves under names with spaces, percent signs, plus signs and brackets, and a padded, upper-case rename source."""
    base = scratch_path(spark, "odd")
    raw = orders_tracker_raw(spark, sf_dir).withColumn("__w", true_wave())
    with staged_copy(raw, "raw") as rows:
        for name, chosen in (("wave 1+2", (1, 2)), ("100% [3-4]", (3, 4)), ("w{5}", (5, 6, 7))):
            part = rows.where(F.col("__w").isin(*chosen)).drop("__w").withColumnRenamed("nps_score", " NPS ")
            if 5 in chosen:
                part = part.withColumn("brand_used", F.lit(None).cast("string"))
            write_csv(part, f"{base}/{name}")
    return ingest_waves(spark, base, DRIFT_CONFIG, recursive=True)[0]


@register("rejects_after_fix", sql.rejects(sql.DRIFT_TYPED))
def q_rejects_after_fix(spark, sf_dir):
    """A first run without the renames rejects less and stores null scores; a run with them replaces all of it."""
    out = f"{scratch_path(spark, 'run')}/out"
    folder = drifted_waves_folder(spark, sf_dir)
    run_tracker(spark, TrackerConfig(), folder, out, recursive=True)
    run_tracker(spark, DRIFT_CONFIG, folder, out, recursive=True)
    return spark.read.parquet(output_paths(out)[2]).select(*CANONICAL_COLUMNS, REJECT_REASON)


@register("retry_after_rename_fix", sql.metrics(sql.features(sql.clean(sql.DRIFT_TYPED)), ["region"]))
def q_retry_after_rename_fix(spark, sf_dir):
    """Files whose rows were all rejected for want of a key column come in with the fixed configuration, incrementally."""
    out = f"{scratch_path(spark, 'run')}/out"
    folder = drifted_waves_folder(spark, sf_dir)
    run_tracker(spark, replace(DRIFT_CONFIG, rename_map={"nps": "nps_score", "respondent_id": "id"}), folder, out, recursive=True)
    run_tracker(spark, DRIFT_CONFIG, folder, out, incremental=True, recursive=True)
    return spark.read.parquet(output_paths(out)[1])


# ---------------------------------------------------------------- upsert and versions

def _upsert_frames(spark, sf_dir):
    t = orders_tracker(spark, sf_dir)
    key = F.col("respondent_id").cast("bigint")
    updated = (t.where(F.col("wave").isin(2, 3) & (key % 5 == 0))
               .withColumn("nps_score", ((F.col("nps_score") + 1) % 11).cast("int")))
    late = (t.where((F.col("wave") == 2) & (key % 7 == 0))
            .withColumn("respondent_id", F.concat("respondent_id", F.lit("-late"))))
    source = updated.unionByName(t.where("wave >= 6")).unionByName(late)
    return t.where("wave <= 5"), source


_BASE = f"SELECT * FROM ({TRACKER}) WHERE wave <= 5"
_MERGED = sql.merged(_BASE, sql.upsert_source(TRACKER))


@register("merge_upsert", _MERGED)
def q_merge_upsert(spark, sf_dir):
    """Key upsert into the parquet store: updates, new keys, a new partition; untouched rows stay."""
    base, source = _upsert_frames(spark, sf_dir)
    path = scratch_path(spark, "store")
    merge_upsert(spark, base, path)
    merge_upsert(spark, source, path)
    return read_store(spark, path, CANONICAL_COLUMNS)


@register("merge_idempotent", _MERGED)
def q_merge_idempotent(spark, sf_dir):
    """The same upsert applied twice changes nothing the second time."""
    base, source = _upsert_frames(spark, sf_dir)
    path = scratch_path(spark, "store")
    merge_upsert(spark, base, path)
    merge_upsert(spark, source, path)
    merge_upsert(spark, source, path)
    return read_store(spark, path, CANONICAL_COLUMNS)


@register("upsert_waves_features", f"SELECT {sql.FEATURE_OUT} FROM ({sql.features(_MERGED)})")
def q_upsert_waves_features(spark, sf_dir):
    """Late and corrected rows merged by key; weight norms recomputed over each whole touched wave."""
    base, source = _upsert_frames(spark, sf_dir)
    path = scratch_path(spark, "store")
    upsert_waves(spark, base, path)
    upsert_waves(spark, source, path)
    return _features_out(read_store(spark, path))


@register("metrics_after_upsert", sql.metrics(sql.features(_MERGED), ["region"]))
def q_metrics_after_upsert(spark, sf_dir):
    """The metrics table follows an upsert into the store."""
    base, source = _upsert_frames(spark, sf_dir)
    resp, metrics, _ = output_paths(f"{scratch_path(spark, 'run')}/out")
    upsert_waves(spark, base, resp, metrics_path=metrics)
    upsert_waves(spark, source, resp, metrics_path=metrics)
    return spark.read.parquet(metrics)


@register("metrics_refresh", sql.metrics(FEATURES, ["region"]))
def q_metrics_refresh(spark, sf_dir):
    """Metrics of waves 1-5, then waves 6-7 re-aggregated alone and combined: equals a full recompute."""
    respondents = add_features(orders_tracker(spark, sf_dir))
    path = scratch_path(spark, "metrics")
    wave_metrics(respondents.where("wave <= 5")).write.parquet(path)
    return refresh_wave_metrics(spark.read.parquet(path), respondents, [6, 7])


def _changes(spark, sf_dir) -> DataFrame:
    """The base rows as change 0 and the upsert's rows as change 1, written as one change table."""
    base, source = _upsert_frames(spark, sf_dir)
    path = scratch_path(spark, "changes")
    for number, rows in enumerate((base, source)):
        rows.withColumn("change", F.lit(number)).write.mode("append").parquet(path)
    return spark.read.parquet(path)


@register("read_as_of", _BASE)
def q_read_as_of(spark, sf_dir):
    """The change table as of its first change."""
    return as_of(_changes(spark, sf_dir), RESPONDENT_KEYS, "change", upto=0).select(*CANONICAL_COLUMNS)


@register("read_latest_version", _MERGED)
def q_read_latest_version(spark, sf_dir):
    """The change table's latest state equals the MERGE result."""
    return as_of(_changes(spark, sf_dir), RESPONDENT_KEYS, "change").select(*CANONICAL_COLUMNS)


@register("version_history", f"""
SELECT 0 AS version, count(*) AS rows_written FROM ({_BASE})
UNION ALL SELECT 1 AS version, count(*) AS rows_written FROM ({sql.upsert_source(TRACKER)})""")
def q_version_history(spark, sf_dir):
    """Rows of each change of the change table."""
    return _changes(spark, sf_dir).groupBy(F.col("change").alias("version")).agg(F.count(F.lit(1)).alias("rows_written"))


@register("dedupe_latest_null_order", f"SELECT {sql.CANONICAL} FROM ({TRACKER})")
def q_dedupe_latest_null_order(spark, sf_dir):
    """Every row twice, once without its order value: the real value wins, and where there is none no column is lost."""
    t = orders_tracker(spark, sf_dir)
    twice = t.withColumn("weight", F.lit(None).cast("double")).unionByName(t)
    return latest_per_key(twice, RESPONDENT_KEYS, "weight")


_LINE_COLS = "l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice"


@register("dedupe_latest", f"""
SELECT {_LINE_COLS}, CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS l_shipdate FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
                               ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC) AS rn
  FROM lineitem) WHERE rn = 1""")
def q_dedupe_latest(spark, sf_dir):
    """Duplicate keys resolved to the latest row (hash aggregate with max_by, no sort)."""
    li = table(spark, sf_dir, "lineitem").select(
        *_LINE_COLS.split(", "), "l_shipdate",
        F.struct("l_shipdate", "l_partkey", "l_suppkey").alias("__order"))
    out = latest_per_key(li, ["l_orderkey", "l_linenumber"], "__order")
    return out.select(*_LINE_COLS.split(", "), F.col("l_shipdate").cast("date").cast("string").alias("l_shipdate"))


@register("duplicate_keys", """
SELECT l_orderkey, l_linenumber, count(*) AS copies FROM lineitem
GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1""")
def q_duplicate_keys(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber")
    return duplicate_keys(li, ["l_orderkey", "l_linenumber"])


# ---------------------------------------------------------------- upserts by any key, metric state, indexes

def _respondent(rows: str) -> str:
    return f"SELECT {sql.CANONICAL} FROM ({rows})"


_MOVES = f"""
SELECT * REPLACE (CAST(6 AS INTEGER) AS wave) FROM ({_respondent(TRACKER)}) WHERE wave = 5
UNION ALL SELECT * REPLACE (CAST(2 AS INTEGER) AS wave) FROM ({_respondent(TRACKER)}) WHERE wave = 1 AND {sql.KEY} % 11 = 0
UNION ALL SELECT * REPLACE (CAST((nps_score + 1) % 11 AS INTEGER) AS nps_score) FROM ({_respondent(TRACKER)}) WHERE wave = 3 AND {sql.KEY} % 5 = 0
UNION ALL SELECT * FROM ({_respondent(TRACKER)}) WHERE wave = 7"""
_MOVED = f"""
SELECT {sql.CANONICAL} FROM ({_BASE}) t WHERE respondent_id NOT IN (SELECT respondent_id FROM ({_MOVES}))
UNION ALL SELECT {sql.CANONICAL} FROM ({_MOVES})"""


def _moves(spark, sf_dir) -> DataFrame:
    """All of wave 5 moved to wave 6, some of wave 1 to wave 2, some of wave 3 corrected, wave 7 new."""
    t, key = orders_tracker(spark, sf_dir), F.col("respondent_id").cast("bigint")
    six = t.where("wave = 5").withColumn("wave", F.lit(6))
    two = t.where((F.col("wave") == 1) & (key % 11 == 0)).withColumn("wave", F.lit(2))
    three = t.where((F.col("wave") == 3) & (key % 5 == 0)).withColumn("nps_score", ((F.col("nps_score") + 1) % 11).cast("int"))
    return six.unionByName(two).unionByName(three).unionByName(t.where("wave = 7"))


def _merged_moves(spark, sf_dir, **options) -> DataFrame:
    path = scratch_path(spark, "store")
    merge_upsert(spark, orders_tracker(spark, sf_dir).where("wave <= 5"), path, ["respondent_id"])
    merge_upsert(spark, _moves(spark, sf_dir), path, ["respondent_id"], **options)
    return read_store(spark, path, CANONICAL_COLUMNS)


@register("merge_moved_rows", _MOVED)
def q_merge_moved_rows(spark, sf_dir):
    """A key upsert whose keys lack the partition column: matches lie in other partitions, one of which empties."""
    return _merged_moves(spark, sf_dir)


@register("merge_moved_rows_files", _MOVED)
def q_merge_moved_rows_files(spark, sf_dir):
    """The same, rewriting only files that hold a key of the source."""
    return _merged_moves(spark, sf_dir, rewrite="files")


_NULL_KEYS = f"""
SELECT * REPLACE (2.0 AS weight, CAST(10 AS INTEGER) AS nps_score) FROM ({_respondent(TRACKER)}) WHERE wave = 2 AND {sql.KEY} % 5 = 0"""


@register("merge_latest_null_keys", f"""
SELECT {sql.CANONICAL} FROM ({_BASE}) WHERE NOT (wave = 2 AND {sql.KEY} % 5 = 0)
UNION ALL {_NULL_KEYS}
UNION ALL SELECT * REPLACE (CAST(NULL AS VARCHAR) AS respondent_id) FROM ({_respondent(TRACKER)}) WHERE wave = 2 AND {sql.KEY} % 7 = 0""")
def q_merge_latest_null_keys(spark, sf_dir):
    """Repeated keys resolved to their latest row; rows without a key are inserted, every one."""
    t, key = orders_tracker(spark, sf_dir), F.col("respondent_id").cast("bigint")
    twice = t.where((F.col("wave") == 2) & (key % 5 == 0))
    source = twice.withColumn("weight", F.lit(1.0)).withColumn("nps_score", F.lit(0)).unionByName(
        twice.withColumn("weight", F.lit(2.0)).withColumn("nps_score", F.lit(10)))
    nameless = t.where((F.col("wave") == 2) & (key % 7 == 0)).withColumn("respondent_id", F.lit(None).cast("string"))
    path = scratch_path(spark, "store")
    merge_upsert(spark, t.where("wave <= 5"), path)
    merge_upsert(spark, source.unionByName(nameless), path, on_duplicate="latest", order_col="weight")
    return read_store(spark, path, CANONICAL_COLUMNS)


@register("upsert_norms_from_state", f"SELECT {sql.FEATURE_OUT} FROM ({sql.features(_MERGED)})")
def q_upsert_norms_from_state(spark, sf_dir):
    """A store without norms: an upsert rewrites only files with its keys, and norms come from the metric state."""
    base, source = _upsert_frames(spark, sf_dir)
    resp, metrics, _ = output_paths(f"{scratch_path(spark, 'run')}/out")
    upsert_waves(spark, base, resp, metrics_path=metrics, norms="state")
    upsert_waves(spark, source, resp, metrics_path=metrics, norms="state")
    return _features_out(read_respondents(spark, resp, metrics))


@register("metrics_of_added_parts", sql.metrics(FEATURES, ["region"]))
def q_metrics_of_added_parts(spark, sf_dir):
    """Metric sums of two halves of every wave, added: equal to those of all rows."""
    t, half = orders_tracker(spark, sf_dir), F.col("respondent_id").cast("bigint") % 2 == 0
    parts = metric_parts(t.where(half), CFG).unionByName(metric_parts(t.where(~half), CFG))
    return metrics_from_parts(add_parts(parts, CFG), CFG)


@register("metrics_follow_the_store", sql.metrics(sql.features(f"SELECT * FROM ({TRACKER}) WHERE wave <> 3 AND NOT (wave = 2 AND {sql.KEY} % 3 = 0)"), ["region"]))
def q_metrics_follow_the_store(spark, sf_dir):
    """Other writers replace one wave and remove another: an upsert-free run finds out from the files and refreshes what changed."""
    from trackframe.plans.run import refresh_metrics
    from trackframe.sources.store import drop_partitions

    resp, metrics, _ = output_paths(f"{scratch_path(spark, 'run')}/out")
    t = orders_tracker(spark, sf_dir)
    write_partitioned(add_features(t), resp)
    refresh_metrics(spark, CFG, resp, metrics)
    write_partitioned(add_features(t.where((F.col("wave") == 2) & (F.col("respondent_id").cast("bigint") % 3 != 0))), resp)
    drop_partitions(spark, resp, [3])
    refresh_metrics(spark, CFG, resp, metrics)
    return spark.read.parquet(metrics)


@register("ingest_many_headers", sql.clean(RAW))
def q_ingest_many_headers(spark, sf_dir):
    """Two hundred files, each with its own header: one scan, one projection."""
    return ingest_waves(spark, many_headers_folder(spark, sf_dir), CFG, pattern="*.txt", recursive=True)[0]


@register("only_waves_indexed", f"SELECT * FROM ({sql.clean(sql.DRIFT_TYPED)}) WHERE wave IN (2, 3, 4)")
def q_only_waves_indexed(spark, sf_dir):
    """Some waves again, after a run: the manifest tells which files hold them, and only those are opened."""
    out = f"{scratch_path(spark, 'run')}/out"
    folder = drifted_waves_folder(spark, sf_dir)
    run_tracker(spark, DRIFT_CONFIG, folder, out, recursive=True)
    return read_waves(spark, folder, out, [2, 3, 4], DRIFT_CONFIG, recursive=True)[0]


@register("harmonise_recode_lookup", f"""
SELECT t.respondent_id, t.wave, CASE WHEN c.c_nationkey % 4 = 3 THEN CAST(c.c_nationkey AS VARCHAR) ELSE n.n_name END AS region
FROM ({TRACKER}) t JOIN orders o ON CAST(o.o_orderkey AS VARCHAR) = t.respondent_id
JOIN customer c ON o.o_custkey = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey""")
def q_harmonise_recode_lookup(spark, sf_dir):
    """Padded nation numbers recoded by the nation table; numbers that are not in it pass through."""
    orders, customer, nation = (table(spark, sf_dir, n) for n in ("orders", "customer", "nation"))
    codes = (orders.join(customer, F.col("o_custkey") == F.col("c_custkey"))
             .select(F.col("o_orderkey").cast("string").alias("respondent_id"), (F.year("o_orderdate") - 1994).cast("int").alias("wave"),
                     F.concat(F.lit(" "), F.col("c_nationkey").cast("string")).alias("region")))
    return recode_lookup(codes, "region", nation.where("n_nationkey % 4 <> 3"), "n_nationkey", "n_name")


@register("stored_waves_sorted", f"""
SELECT CAST(row_number() OVER (ORDER BY wave) AS INTEGER) AS place, wave FROM (SELECT DISTINCT wave FROM ({TRACKER}) WHERE wave > 2)""")
def q_stored_waves_sorted(spark, sf_dir):
    """The driver's list of stored waves, in order."""
    path = scratch_path(spark, "store")
    write_partitioned(orders_tracker(spark, sf_dir).where("wave > 2"), path)
    return spark.createDataFrame(list(enumerate(existing_waves(spark, path), 1)), "place int, wave int")


@register("store_exists", f"SELECT wave, wave % 2 = 0 AS stored FROM (SELECT DISTINCT wave FROM ({TRACKER}))")
def q_store_exists(spark, sf_dir):
    """A store for every other wave: which paths hold one."""
    base, t = scratch_path(spark, "stores"), orders_tracker(spark, sf_dir)
    waves = sorted(r["wave"] for r in t.select("wave").distinct().collect())
    for w in waves:
        if w % 2 == 0:
            write_partitioned(t.where(F.col("wave") == w), f"{base}/{w}")
    return spark.createDataFrame([(w, store_exists(spark, f"{base}/{w}")) for w in waves], "wave int, stored boolean")


@register("config_from_document", sql.metrics(sql.features(TRACKER, 8, 5, 5), ["age_group"], zero_fill=True))
def q_config_from_document(spark, sf_dir):
    """Metrics under a configuration given as a document."""
    cfg = TrackerConfig.from_mapping({"segment_cols": ["age_group"], "options": {"zero_fill": True},
                                      "metrics": {"promoter_min": "8", "detractor_max": 5, "top2box_min": 5}})
    return _metrics(spark, sf_dir, cfg)


@register("rejects_only_if_any", f"SELECT count(*) AS rejected FROM ({sql.rejects(RAW)}) HAVING count(*) > 0")
def q_rejects_only_if_any(spark, sf_dir):
    """Two runs, one over clean rows only: rows of the reject tables that exist."""
    counts = []
    for name, clean_only in (("clean", True), ("all", False)):
        base = scratch_path(spark, f"run-{name}")
        raw = orders_tracker_raw(spark, sf_dir)
        if clean_only:
            raw = enforce_contract(raw)[0]
        write_csv(raw, f"{base}/in")
        run_tracker(spark, CFG, f"{base}/in", f"{base}/out")
        if store_exists(spark, output_paths(f"{base}/out")[2]):
            counts.append(spark.read.parquet(output_paths(f"{base}/out")[2]).agg(F.count(F.lit(1)).alias("rejected")))
    return counts[0] if len(counts) == 1 else counts[0].union(counts[1])


# ---------------------------------------------------------------- streaming

@register("stream_ingest", f"SELECT {sql.FEATURE_OUT} FROM ({CLEAN_FEATURES})")
def q_stream_ingest(spark, sf_dir):
    """Wave files land in two drops; an available-now stream folds each drop into the store."""
    root = scratch_path(spark, "stream")
    for drop, waves in (("a", [1, 2, 3]), ("b", [4, 5, 6, 7])):
        stage_canonical_waves(spark, sf_dir, waves, f"{root}/landing/{drop}")
        stream_waves(spark, f"{root}/landing/*/*.csv", f"{root}/out", CFG).awaitTermination()
    return _features_out(read_store(spark, output_paths(f"{root}/out")[0]))
