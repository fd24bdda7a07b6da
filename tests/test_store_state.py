"""Upserts by any key, file-wise rewrites, folder listings, the metric state, rejects by bucket, runs that end empty."""

from __future__ import annotations

import os
import random
import re

import pytest

from conftest import deliver, sheets
from trackframe.config import TrackerConfig
from trackframe.operators.harmonise import recode_lookup
from trackframe.operators.metrics import wave_metrics_direct
from trackframe.operators.upsert import DuplicateKeyError, SourceColumnsError, merge_upsert
from trackframe.plans import run as run_module
from trackframe.plans.run import files_of_waves, manifest_path, output_paths, read_waves, refresh_metrics, run_tracker, upsert_waves
from trackframe.sources import state as state_module
from trackframe.sources.state import read_respondents, read_state, state_path
from trackframe.sources.store import existing_waves, open_store, partition_folders, read_store, store_exists, stored_values, stored_waves, write_partitioned
from trackframe.streaming.waves import process_files

CFG = TrackerConfig()
KV = "wave int, id string, v int"


def rows(spark, path):
    return sorted(((r["wave"], r["id"], r["v"]) for r in spark.read.parquet(path).collect()), key=str)


def files(path):
    return {os.path.join(d, f): os.path.getmtime(os.path.join(d, f)) for d, _, fs in os.walk(path) for f in fs if f.endswith(".parquet")}


@pytest.mark.parametrize("rewrite", ["partitions", "files"])
def test_keys_match_in_every_partition(spark, tmp_path, rewrite):
    path = str(tmp_path / "s")
    base = [(1, "a", 1), (1, "b", 1), (2, "c", 1), (None, "d", 1), (3, None, 1), (4, "e", 1)]
    merge_upsert(spark, spark.createDataFrame(base, KV), path, ["id"])
    # "a" moves to wave 2, "c" leaves wave 2 empty but for "a", "e" empties wave 4, "d" leaves the null wave; null keys match nothing.
    source = spark.createDataFrame([(2, "a", 2), (5, "c", 2), (1, "e", 2), (1, "d", 2), (3, None, 2)], KV)
    merge_upsert(spark, source, path, ["id"], rewrite=rewrite)
    expected = sorted([(2, "a", 2), (1, "b", 1), (5, "c", 2), (1, "d", 2), (3, None, 1), (3, None, 2), (1, "e", 2)], key=str)
    assert rows(spark, path) == expected
    assert stored_values(spark, path) == [1, 2, 3, 5]
    again = spark.createDataFrame([(2, "a", 2), (5, "c", 2), (1, "e", 2), (1, "d", 2)], KV)
    merge_upsert(spark, again, path, ["id"], rewrite=rewrite)
    assert rows(spark, path) == expected


@pytest.mark.parametrize("rewrite", ["partitions", "files"])
def test_upserts_equal_a_plain_merge(spark, tmp_path, rewrite):
    rng = random.Random(4)
    path, held = str(tmp_path / "s"), {}
    for change in range(3):
        source = {f"k{rng.randint(0, 40)}": (rng.randint(1, 5), change) for _ in range(15)}
        held |= source
        merge_upsert(spark, spark.createDataFrame([(w, k, v) for k, (w, v) in source.items()], KV).repartition(3), path, ["id"], rewrite=rewrite)
        assert rows(spark, path) == sorted(((w, k, v) for k, (w, v) in held.items()), key=str)


def test_file_rewrite_leaves_other_files_alone(spark, tmp_path):
    path = str(tmp_path / "s")
    for part in range(4):  # four files of one wave
        df = spark.createDataFrame([(1, f"k{part}{i}", 0) for i in range(5)], KV).coalesce(1)
        write_partitioned(df, path, mode="append")
    before = files(path)
    merge_upsert(spark, spark.createDataFrame([(1, "k23", 9), (1, "new", 9)], KV), path, ["wave", "id"], rewrite="files")
    after = files(path)
    assert len(before) == 4 and sum(f in after and after[f] == t for f, t in before.items()) == 3
    got = {r["id"]: r["v"] for r in spark.read.parquet(path).collect()}
    assert len(got) == 21 and got["k23"] == got["new"] == 9
    with pytest.raises(ValueError):
        merge_upsert(spark, spark.createDataFrame([(1, "a", 1)], KV), path, ["wave", "id"], rewrite="files", finish=lambda d: d)


def test_latest_keeps_every_row_without_a_key(spark, tmp_path):
    path = str(tmp_path / "s")
    source = spark.createDataFrame([(1, None, 1), (1, None, 2), (1, "a", 1), (1, "a", 5)], KV)
    merge_upsert(spark, source, path, ["id"], on_duplicate="latest", order_col="v")
    assert rows(spark, path) == [(1, "a", 5), (1, None, 1), (1, None, 2)]
    with pytest.raises(DuplicateKeyError):
        merge_upsert(spark, source, path, ["id"])


def test_source_must_have_the_stored_columns(spark, tmp_path):
    path = str(tmp_path / "s")
    merge_upsert(spark, spark.createDataFrame([(1, "a", 7)], KV), path, ["id"])
    for source in (spark.createDataFrame([(1, "b")], "wave int, id string"), spark.createDataFrame([(1, "b", 1, 2)], KV + ", w int")):
        with pytest.raises(SourceColumnsError):
            merge_upsert(spark, source, path, ["id"])
    assert rows(spark, path) == [(1, "a", 7)]


@pytest.mark.parametrize("norms", ["stored", "state"])
def test_order_column_that_is_not_stored_works_again_and_again(spark, tmp_path, norms):
    resp, metrics, _ = output_paths(str(tmp_path))
    canon = ("respondent_id string, wave int, fieldwork_date string, region string, age_group string, weight double, "
             "nps_score int, satisfaction int, aware int, brand_used string, received int")
    for score, received in ((3, 1), (9, 2)):
        late = [("a", 1, None, "N", None, 1.0, score + d, 3, 1, None, 10 * received + d) for d in (0, 1)]
        upsert_waves(spark, spark.createDataFrame(late, canon), resp, metrics_path=metrics, on_duplicate="latest", order_col="received", norms=norms)
        (row,) = read_respondents(spark, resp, metrics).collect()
        assert (row["nps_score"], row["weight_norm"]) == (score + 1, 1.0)


def test_folders_tell_partition_values(spark, tmp_path):
    values = ["a, b", "x/y=z", "100%", "", None, "[q]*", "ü", "1:2"]
    path = str(tmp_path / "odd [name], 1%")
    spark.createDataFrame([(v, i) for i, v in enumerate(values)], "wave string, n int").write.partitionBy("wave").parquet(path)
    # Spark writes an empty string as it writes null.
    assert set(stored_values(spark, path)) == {v or None for v in values}
    assert {r["wave"] for r in stored_waves(spark, path).collect()} == set(stored_values(spark, path))
    numbers = str(tmp_path / "n")
    spark.createDataFrame([(b, w) for b in (1, 2) for w in (3, -4, None)], "bucket int, wave int").selectExpr("*", "1 AS v").write.partitionBy("bucket", "wave").parquet(numbers)
    assert stored_values(spark, numbers) == [-4, 3, None] and existing_waves(spark, numbers) == [-4, 3]
    assert len(partition_folders(spark, numbers)) == 6 and stored_values(spark, numbers, "none") == []
    frame = stored_waves(spark, numbers)
    assert "FileScan" not in frame._jdf.queryExecution().executedPlan().toString() and dict(frame.dtypes) == {"wave": "int"}
    assert stored_waves(spark, str(tmp_path / "absent")).count() == 0


def test_only_a_folder_without_data_passes_for_no_store(spark, tmp_path):
    (tmp_path / "empty").mkdir()
    assert not store_exists(spark, str(tmp_path / "empty")) and not store_exists(spark, str(tmp_path / "none"))
    (tmp_path / "broken").mkdir()
    (tmp_path / "broken" / "part-0.parquet").write_bytes(b"not parquet at all")
    with pytest.raises(Exception):  # noqa: B017 - whatever Spark says, but no None
        open_store(spark, str(tmp_path / "broken"))


def metrics_of(spark, out, config=CFG):
    resp, metrics, _ = output_paths(out)
    got = sorted(map(str, spark.read.parquet(metrics).collect()))
    assert got == sorted(map(str, wave_metrics_direct(read_store(spark, resp).drop("weight_norm"), config).collect()))
    return got


def test_state_follows_whatever_writes_to_the_store(spark, tmp_path, monkeypatch):
    read = []
    real = state_module.metric_parts
    monkeypatch.setattr(state_module, "metric_parts", lambda df, cfg: read.append(sorted(r[0] for r in df.select("wave").distinct().collect())) or real(df, cfg))
    raw, out = tmp_path / "raw", str(tmp_path / "out")
    for w in (1, 2, 3):
        deliver(raw, f"{w}.csv", *sheets(w, a=w, b=10, c=0))
    run_tracker(spark, CFG, str(raw), out)
    resp, metrics, _ = output_paths(out)
    metrics_of(spark, out)
    # Another writer replaces wave 2; a refresh notices, and one that changes nothing reads nothing.
    fewer = read_store(spark, resp).where("wave = 2 AND respondent_id <> 'c'")
    write_partitioned(spark.createDataFrame(fewer.collect(), fewer.schema), resp)
    assert refresh_metrics(spark, CFG, resp, metrics) == 3
    refresh_metrics(spark, CFG, resp, metrics)
    metrics_of(spark, out)
    # Settings that only show in derived numbers need no rows; others need all of them.
    zero = TrackerConfig(zero_fill=True)
    refresh_metrics(spark, zero, resp, metrics)
    metrics_of(spark, out, zero)
    other = TrackerConfig(promoter_min=8)
    refresh_metrics(spark, other, resp, metrics)
    assert read == [[1, 2, 3], [2], [1, 2, 3]]
    state_module.drop_partitions(spark, resp, [1])
    assert refresh_metrics(spark, other, resp, metrics) == 2
    assert {r["wave"] for r in read_state(spark, metrics).select("wave").distinct().collect()} == {2, 3}
    state_module.drop_path(spark, resp)
    assert refresh_metrics(spark, other, resp, metrics) == 0 and not os.path.exists(state_path(metrics)) and not os.path.exists(metrics)


def test_batches_and_upserts_read_touched_waves_only(spark, tmp_path, monkeypatch):
    plans = []
    real = state_module.metric_parts

    def spy(df, cfg):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return real(df, cfg)
    monkeypatch.setattr(state_module, "metric_parts", spy)
    land, out = tmp_path / "land", str(tmp_path / "out")
    for norms in ("stored", "state"):
        for name, wave in (("one", 1), ("two", 2), ("late", 1)):
            path = deliver(land, f"{norms}-{name}.csv", *sheets(wave, **{f"{name}{norms}": 7, "x": 9}))
            process_files(spark, [path], out + norms, CFG, norms=norms)
        metrics_of(spark, out + norms)
        filters = re.findall(r"PartitionFilters: \[(.*?)\]", plans[-1])
        assert len(filters) == 1 and re.findall(r"wave#\d+ (=|IN) (\S+?)\)", filters[0]) == [("=", "1")]


def test_a_late_row_rewrites_no_untouched_file(spark, tmp_path):
    raw, out = tmp_path / "raw", str(tmp_path / "out")
    deliver(raw, "1.csv", *sheets(1, a=1, b=2))
    deliver(raw, "2.csv", *sheets(2, c=1, d=2))
    run_tracker(spark, CFG, str(raw), out, norms="state")
    resp, metrics, _ = output_paths(out)
    before = files(resp)
    late = deliver(tmp_path / "late", "l.csv", {"respondent_id": "e", "wave": "1", "weight": "4"})
    process_files(spark, [late], out, CFG, norms="state")
    after = files(resp)
    assert set(before.items()) < set(after.items())
    norms = {r["respondent_id"]: r["weight_norm"] for r in read_respondents(spark, resp, metrics).collect()}
    assert norms == {"a": 0.5, "b": 0.5, "e": 2.0, "c": 1.0, "d": 1.0}


def test_rejects_rewrite_only_the_buckets_of_the_files_read(spark, tmp_path):
    raw, out = tmp_path / "raw", str(tmp_path / "out")
    for i in range(8):
        deliver(raw, f"f{i}.csv", *sheets(i + 1, ok=5), {"respondent_id": f"bad{i}", "wave": str(i + 1), "nps_score": "77"}, {"respondent_id": f"w{i}", "wave": ""})
    run_tracker(spark, CFG, str(raw), out)
    side = output_paths(out)[2]
    before = files(side)
    deliver(raw, "f3.csv", *sheets(4, ok=5), *sheets(9, more=5))  # both its rejects are gone
    run_tracker(spark, CFG, str(raw), out, incremental=True)
    left = spark.read.parquet(side)
    assert sorted(r[0] for r in left.select("respondent_id").collect()) == sorted(f"{k}{i}" for i in range(8) if i != 3 for k in ("bad", "w"))
    after = files(side)
    kept = [f for f, t in before.items() if after.get(f) == t]
    assert len(kept) >= len(before) - 4 and len(kept) < len(before)
    for i in range(8):
        deliver(raw, f"f{i}.csv", *sheets(i + 11, ok=5))
    run_tracker(spark, CFG, str(raw), out, incremental=True)
    assert not store_exists(spark, side)


def test_a_full_run_without_a_clean_row(spark, tmp_path):
    raw, out = tmp_path / "raw", str(tmp_path / "out")
    deliver(raw, "w.csv", *sheets(1, a=1), *sheets(2, b=2))
    run_tracker(spark, CFG, str(raw), out)
    deliver(raw, "w.csv", {"respondent_id": "z", "wave": "1", "nps_score": "99"})
    kept = run_tracker(spark, CFG, str(raw), out)  # by default a run replaces the waves it writes: none
    assert (kept.metric_rows, existing_waves(spark, output_paths(out)[0])) == (2, [1, 2])
    gone = run_tracker(spark, CFG, str(raw), out, replace="table")
    assert (gone.mode, gone.clean_rows, gone.reject_rows, gone.metric_rows) == ("full", 0, 1, 0)
    assert not any(store_exists(spark, p) for p in output_paths(out)[:2]) and store_exists(spark, output_paths(out)[2])
    open(raw / "w.csv", "w").close()
    assert run_tracker(spark, CFG, str(raw), out, replace="table").metric_rows == 0


def test_rejects_are_written_after_the_respondents(spark, tmp_path, monkeypatch):
    raw, out = tmp_path / "raw", str(tmp_path / "out")
    deliver(raw, "w.csv", *sheets(1, a=1), {"respondent_id": "z", "wave": "1", "nps_score": "99"})
    monkeypatch.setattr(run_module, "write_partitioned", lambda *a, **k: (_ for _ in ()).throw(OSError("disk full")))
    with pytest.raises(OSError):
        run_tracker(spark, CFG, str(raw), out)
    assert not any(store_exists(spark, p) for p in (*output_paths(out), manifest_path(out)))


def test_wave_index_opens_matching_files_only(spark, tmp_path):
    raw, out = tmp_path / "raw", str(tmp_path / "out")
    for w in (1, 2, 3):
        deliver(raw, f"{w}.csv", *sheets(w, a=w), {"respondent_id": "bad", "wave": str(w), "nps_score": "99"})
    deliver(raw, "mixed.csv", *sheets(2, m=0), *sheets(3, n=0))

    def names(waves, config=CFG):
        return sorted(os.path.basename(r[0]) for r in files_of_waves(spark, str(raw), out, waves, config).select("file_path").collect())
    assert names([2]) == ["1.csv", "2.csv", "3.csv", "mixed.csv"]  # nothing known yet
    run_tracker(spark, CFG, str(raw), out)
    assert names([2]) == ["2.csv", "mixed.csv"] and names([1, 3]) == ["1.csv", "3.csv", "mixed.csv"] and names([9]) == []
    assert names([2], TrackerConfig(strict_parse=True)) == ["1.csv", "2.csv", "3.csv", "mixed.csv"]
    deliver(raw, "3.csv", *sheets(2, late=1), *sheets(3, a=3))
    clean, rejects = read_waves(spark, str(raw), out, [2])
    assert sorted(r["respondent_id"] for r in clean.collect()) == ["a", "late", "m"] and [r["respondent_id"] for r in rejects.collect()] == ["bad"]
    clean, rejects = read_waves(spark, str(raw), out, [9])  # only the changed file may hold it
    assert clean.count() == rejects.count() == 0


def test_recode_by_a_table(spark):
    df = spark.createDataFrame([(1, " N "), (2, "S"), (3, "?"), (4, None)], "id int, Region string")
    table = spark.createDataFrame([("N", "North"), ("N", "North"), ("S", "N"), (None, "none"), ("x", None)], "code string, label string")
    got = {r["id"]: r["Region"] for r in recode_lookup(df, "region", table, "code", "label").collect()}
    assert got == {1: "North", 2: "N", 3: "?", 4: None} and recode_lookup(df, "region", table, "code", "label").columns == ["id", "Region"]
    assert recode_lookup(df, "absent", table, "code", "label") is df
    with pytest.raises(Exception, match="different values"):
        recode_lookup(df, "region", table.union(spark.createDataFrame([("N", "Nord")], "code string, label string")), "code", "label").collect()
    plan = recode_lookup(df, "region", table, "code", "label")._jdf.queryExecution().analyzed().toString()
    assert "hint" not in plan.lower()
