"""Wave CSV files derived from the driver tables by Spark, for the file-based queries.

The dirty orders view is written as CSV in three header dialects, the way a
tracker's fieldwork houses drift over time:

* wave 1 (legacy): ``nps`` instead of ``nps_score``, region as two-letter codes
  padded with spaces, columns in another order;
* waves 2-4: canonical columns, but the wave header is written `` Wave ``;
* waves 5-7: no ``brand_used``, plus an extra ``interviewer`` column.

Groups are chosen by the true order year (``fieldwork_date``), so rows whose
wave text is corrupted still land in their wave's file.
"""

from __future__ import annotations

import weakref

from pyspark.sql import DataFrame, SparkSession, functions as F

from trackframe.config import TrackerConfig
from trackframe.plans.views import orders_tracker_raw
from trackframe.session import path_exists, scratch_path, staged_copy

# Region codes of the legacy wave.
REGION_CODES = {"AFRICA": "AF", "AMERICA": "AM", "ASIA": "AS", "EUROPE": "EU", "MIDDLE EAST": "ME"}

DRIFT_CONFIG = TrackerConfig(
    rename_map={"nps": "nps_score"},
    region_map={code: name for name, code in REGION_CODES.items()},
)


def true_wave() -> F.Column:
    return (F.substring("fieldwork_date", 1, 4).cast("int") - 1994).cast("int")


def _legacy(raw: DataFrame) -> DataFrame:
    code = F.concat(F.lit(" "), F.coalesce(F.create_map(
        *[F.lit(x) for kv in REGION_CODES.items() for x in kv])[F.col("region")], F.col("region")), F.lit(" "))
    return raw.select("wave", "respondent_id", F.col("nps_score").alias("nps"), code.alias("region"),
                      "age_group", "weight", "satisfaction", "aware", "fieldwork_date", "brand_used")


def _renamed_wave(raw: DataFrame) -> DataFrame:
    return raw.select("respondent_id", F.col("wave").alias(" Wave "), *[c for c in raw.columns
                                                                        if c not in ("respondent_id", "wave")])


def _extra_column(raw: DataFrame) -> DataFrame:
    k = F.coalesce(F.col("respondent_id"), F.lit("0")).cast("bigint")
    return raw.select(*[c for c in raw.columns if c != "brand_used"],
                      F.concat(F.lit("I"), (k % 10).cast("string")).alias("interviewer"))


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("errorifexists").option("header", "true").csv(path)


def stage_drifted_waves(spark: SparkSession, sf_dir: str, waves=range(1, 8), base: str | None = None,
                        files_per_group: int | None = None) -> str:
    """Write the dirty orders view as drifting CSV groups; returns the folder.

    ``files_per_group`` splits the rows round-robin, so that every header group
    is delivered as about that many files.
    """
    base = base or scratch_path(spark, "waves")
    raw = orders_tracker_raw(spark, sf_dir).withColumn("__true_wave", true_wave())
    raw = raw.where(F.col("__true_wave").isin(list(waves)))
    if files_per_group:
        raw = raw.repartition(files_per_group)
    groups = [("legacy", [1], _legacy), ("renamed", [2, 3, 4], _renamed_wave), ("extra", [5, 6, 7], _extra_column)]
    with staged_copy(raw, "raw") as rows:  # three writes read the same rows
        for name, ws, shape in groups:
            chosen = [w for w in ws if w in set(waves)]
            if chosen:
                write_csv(shape(rows.where(F.col("__true_wave").isin(chosen)).drop("__true_wave")), f"{base}/{name}")
    return base


HEADERS = 200


def many_headers_folder(spark: SparkSession, sf_dir: str) -> str:
    """The dirty orders view as ``HEADERS`` files, each with a header of its own: columns rotated, one extra column at some place."""
    raw = orders_tracker_raw(spark, sf_dir)
    shape = F.pmod(F.xxhash64(*raw.columns), F.lit(HEADERS)).cast("int")

    def line(fields: F.Column, extra: F.Column) -> F.Column:
        turn, place = F.col("shape") % 10, (F.floor(F.col("shape") / 10) % 10).cast("int")
        turned = F.concat(F.slice(fields, turn + 1, F.lit(10) - turn), F.slice(fields, F.lit(1), turn))
        return F.array_join(F.array_insert(turned, place + 1, extra), ",", "")
    names, values = F.array(*map(F.lit, raw.columns)), F.array(*[F.col(c).cast("string") for c in raw.columns])
    rows = raw.select(shape.alias("shape"), "*").select("shape", F.lit(1).alias("nth"), line(values, F.lit("e")).alias("value"))
    heads = rows.select("shape").distinct().select("shape", F.lit(0).alias("nth"), line(names, F.concat(F.lit("x"), "shape")).alias("value"))
    path = scratch_path(spark, "headers-fixture")
    rows.union(heads).repartition("shape").sortWithinPartitions("shape", "nth").select("shape", "value").write.partitionBy("shape").text(path)
    return path


# Fixture folders are deterministic functions of (table folder, waves, layout)
# and are never modified after they are written, so each is written once per
# session and reused.
_WRITTEN: "weakref.WeakKeyDictionary[SparkSession, dict[tuple, str]]" = weakref.WeakKeyDictionary()


def drifted_waves_folder(spark: SparkSession, sf_dir: str, waves=range(1, 8),
                         files_per_group: int | None = None) -> str:
    """The drifting CSV fixture for these waves, written on first use in this session."""
    key = ("drifted", sf_dir.rstrip("/"), tuple(waves), files_per_group)
    known = _WRITTEN.setdefault(spark, {})
    if key not in known or not path_exists(spark, known[key]):
        known[key] = stage_drifted_waves(spark, sf_dir, waves, files_per_group=files_per_group)
    return known[key]


def stage_canonical_waves(spark: SparkSession, sf_dir: str, waves, path: str) -> str:
    """Write the dirty orders view with the canonical header, for the selected true waves."""
    raw = orders_tracker_raw(spark, sf_dir)
    write_csv(raw.where(true_wave().isin(list(waves))), path)
    return path
