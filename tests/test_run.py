"""End-to-end runs over CSV waves: full, repeated, incremental, rejects, upserts, change tables."""

from __future__ import annotations

import os

import pytest

from conftest import deliver, sheets
from trackframe.config import TrackerConfig
from trackframe.operators.upsert import DuplicateKeyError, as_of, latest_per_key, merge_frames, merge_upsert
from trackframe.plans.run import manifest_path, output_paths, run_tracker, upsert_waves
from trackframe.sources import store
from trackframe.sources.ingest import discover_wave_files, ingest_waves, wave_file_headers
from trackframe.sources.store import existing_waves, read_store

CFG = TrackerConfig()


def stored(spark, out):
    return sorted((r["wave"], r["respondent_id"], r["nps_score"]) for r in read_store(spark, output_paths(out)[0]).collect())


def rejected(spark, out):
    table = store.open_store(spark, output_paths(out)[2])
    return [] if table is None else sorted((r["respondent_id"], r["reject_reason"]) for r in table.collect())


def test_life_of_a_tracker(spark, tmp_path):
    """Deliveries come in, are corrected and repeated; every run leaves exactly what the files say."""
    raw, out = tmp_path / "deliveries", str(tmp_path / "out")
    deliver(raw, "spring.csv", *sheets(3, ada=10, bo=2, cy=6))
    deliver(raw, "summer.csv", *sheets(4, ada=8, dee=9), {"respondent_id": "eve", "wave": "4", "satisfaction": "9"},
            {"respondent_id": "fay", "wave": "?"}, {"respondent_id": "gus", "wave": "5", "weight": "-2"})
    first = run_tracker(spark, CFG, str(raw), out)
    assert (first.mode, first.waves_processed, first.clean_rows, first.reject_rows, first.metric_rows) == ("full", [3, 4], 5, 3, 2)
    after = stored(spark, out)
    assert after == [(3, "ada", 10), (3, "bo", 2), (3, "cy", 6), (4, "ada", 8), (4, "dee", 9)]
    bad = [("eve", "satisfaction out of range 1-5"), ("fay", "missing wave"), ("gus", "weight not positive")]
    assert rejected(spark, out) == bad
    assert run_tracker(spark, CFG, str(raw), out) == first and stored(spark, out) == after and rejected(spark, out) == bad

    deliver(raw, "autumn.csv", *sheets(6, hal=0))
    third = run_tracker(spark, CFG, str(raw), out, incremental=True)
    assert (third.mode, third.waves_processed, third.clean_rows, third.metric_rows) == ("incremental", [6], 1, 3)
    assert existing_waves(spark, output_paths(out)[0]) == [3, 4, 6] and rejected(spark, out) == bad
    nothing = run_tracker(spark, CFG, str(raw), out, incremental=True)
    assert (nothing.waves_processed, nothing.metric_rows) == ([], 3) and len(stored(spark, out)) == 6

    # The summer delivery is corrected: its rejects go, its late wave comes in.
    deliver(raw, "summer.csv", *sheets(4, ada=8, dee=9), *sheets(5, gus=7))
    fixed = run_tracker(spark, CFG, str(raw), out, incremental=True)
    assert fixed.waves_processed == [5] and rejected(spark, out) == []
    assert run_tracker(spark, CFG, str(raw), out).reject_rows == 0


def test_counts_of_four_waves_with_a_few_bad_rows(spark, tmp_path):
    """Four waves of 300, three broken answers in each, four regions: 1188 stored, 12 rejected, 16 metric rows."""
    raw, out = tmp_path / "raw", str(tmp_path / "out")
    broken = {7: {"nps_score": "41"}, 77: {"weight": "-0.5"}, 177: {"satisfaction": "0"}}
    for wave in range(1, 5):
        rows = [{"respondent_id": f"{wave}.{i}", "wave": str(wave), "region": "NESW"[i % 4], "nps_score": str(i % 11), **broken.get(i, {})}
                for i in range(300)]
        deliver(raw, f"{wave}.csv", *rows, rename={"nps_score": "nps"} if wave == 1 else None)
    cfg = TrackerConfig(rename_map={"nps": "nps_score"}, region_map={"N": "North", "E": "East", "S": "South", "W": "West"})
    run = run_tracker(spark, cfg, str(raw), out)
    assert (run.clean_rows, run.reject_rows, run.metric_rows) == (1188, 12, 16)
    assert read_store(spark, output_paths(out)[0]).count() == 1188


def test_config_changes_reach_stored_waves_and_skipped_files(spark, tmp_path):
    raw, out = tmp_path / "raw", str(tmp_path / "out")
    deliver(raw, "1.csv", *sheets(1, a=10, b=9))
    deliver(raw, "2.csv", *sheets(2, c=1), rename={"respondent_id": "who"})
    run = run_tracker(spark, CFG, str(raw), out)
    assert run.waves_processed == [1] and [r[1] for r in rejected(spark, out)] == ["missing respondent_id"]
    assert spark.read.parquet(output_paths(out)[1]).first()["nps"] is None  # promoters only
    cfg = TrackerConfig(rename_map={"who": "respondent_id"}, zero_fill=True)
    run = run_tracker(spark, cfg, str(raw), out, incremental=True)
    assert run.waves_processed == [2] and rejected(spark, out) == []
    assert {r["wave"]: r["nps"] for r in spark.read.parquet(output_paths(out)[1]).collect()} == {1: 100.0, 2: -100.0}


def test_incremental_runs_skip_only_files_that_can_add_nothing(spark, tmp_path, monkeypatch):
    import trackframe.plans.run as run_module

    read = []
    real = run_module.ingest_tagged
    monkeypatch.setattr(run_module, "ingest_tagged", lambda s, paths, *a, **k: read.append(sorted(map(os.path.basename, paths))) or real(s, paths, *a, **k))
    raw, out = tmp_path / "raw", str(tmp_path / "out")
    for w in (1, 2):
        deliver(raw, f"{w}.csv", *sheets(w, a=3))
    run_tracker(spark, CFG, str(raw), out)
    deliver(raw, "3.csv", *sheets(3, a=3))
    run_tracker(spark, CFG, str(raw), out, incremental=True)
    store.drop_path(spark, f"{output_paths(out)[0]}/wave=2")  # a stored wave is lost: its file is read again
    assert run_tracker(spark, CFG, str(raw), out, incremental=True).waves_processed == [2]
    run_tracker(spark, TrackerConfig(strict_parse=True), str(raw), out, incremental=True)
    assert read == [["1.csv", "2.csv"], ["3.csv"], ["2.csv"], ["1.csv", "2.csv", "3.csv"]]
    assert spark.read.parquet(manifest_path(out)).count() == 7


def test_upsert_runs_keep_respondents_that_are_not_in_the_input(spark, tmp_path):
    raw, out = tmp_path / "raw", str(tmp_path / "out")
    deliver(raw, "w.csv", *sheets(1, a=4, b=5))
    run_tracker(spark, CFG, str(raw), out, write="upsert")
    deliver(raw, "w.csv", *sheets(1, b=9, c=0))
    run = run_tracker(spark, CFG, str(raw), out, write="upsert")
    assert run.clean_rows == 2 and stored(spark, out) == [(1, "a", 4), (1, "b", 9), (1, "c", 0)]
    assert spark.read.parquet(output_paths(out)[1]).first()["n"] == 3


def test_upsert_refreshes_metrics_and_refuses_duplicates(spark, tmp_path):
    raw, out = tmp_path / "raw", str(tmp_path / "out")
    deliver(raw, "w.csv", *sheets(1, a=10, b=0))
    run_tracker(spark, CFG, str(raw), out)
    resp, metrics, _ = output_paths(out)
    late, _ = ingest_waves(spark, deliver(tmp_path / "late", "l.csv", *sheets(1, c=10, d=10)), pattern="")
    assert upsert_waves(spark, late, resp, metrics_path=metrics) == [1]
    assert [(r["n"], r["nps"]) for r in spark.read.parquet(metrics).collect()] == [(4, 50.0)]
    with pytest.raises(DuplicateKeyError):
        upsert_waves(spark, late.union(late), resp)
    assert len(stored(spark, out)) == 4


def test_odd_file_names_and_headers(spark, tmp_path):
    raw = tmp_path / "raw"
    names = ["a b.csv", "50%.csv", "x+y.csv", "[z].csv", "q{1,2}.csv", "%20.csv"]
    for i, name in enumerate(names):
        deliver(raw, name, *sheets(1, **{f"p{i}": i}), rename={"nps_score": " NPS "})
    with open(raw / "twice.csv", "w") as fh:
        fh.write("wave,Wave,respondent_id\n2,3,t\n")
    open(raw / "nothing.csv", "w").close()
    found = discover_wave_files(spark, str(raw))
    assert sorted(map(os.path.basename, found)) == sorted([*names, "twice.csv", "nothing.csv"])
    clean, rejects = ingest_waves(spark, str(raw), TrackerConfig(rename_map={"nps": "nps_score"}), keep_source=True)
    got = {r["respondent_id"]: (r["wave"], r["nps_score"]) for r in clean.collect()}
    assert got == {**{f"p{i}": (1, i) for i in range(len(names))}, "t": (2, None)} and rejects.count() == 0
    run = run_tracker(spark, CFG, str(raw), str(tmp_path / "out"))
    assert run.waves_processed == [1, 2]


def test_only_empty_files(spark, tmp_path):
    (tmp_path / "raw").mkdir()
    open(tmp_path / "raw" / "e.csv", "w").close()
    clean, rejects = ingest_waves(spark, str(tmp_path / "raw"))
    assert clean.count() == rejects.count() == 0
    assert run_tracker(spark, CFG, str(tmp_path / "raw"), str(tmp_path / "out")).waves_processed == []


def test_header_job_reads_only_the_start_of_a_file(spark, tmp_path):
    raw = tmp_path / "raw"
    raw.mkdir()
    with open(raw / "big.csv", "w") as fh:
        fh.write("\n\nrespondent_id,wave\n" + "".join(f"r{i},1\n" for i in range(2_000_000)))
    bytes_read = spark.sparkContext._jvm.org.apache.hadoop.fs.FileSystem.getStatistics("file", spark.sparkContext._jvm.java.lang.Class.forName("org.apache.hadoop.fs.LocalFileSystem"))
    before = bytes_read.getBytesRead()
    got = wave_file_headers(spark, str(raw)).collect()
    assert [r["header"] for r in got] == ["respondent_id,wave"]
    assert bytes_read.getBytesRead() - before < 4_000_000 < os.path.getsize(raw / "big.csv")


def test_implausible_partition_column_fails_before_writing(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(store, "MAX_PARTITIONS", 3)
    df = spark.createDataFrame([(i, str(i), i) for i in range(5)], "wave int, respondent_id string, v int")
    with pytest.raises(store.TooManyPartitionsError):
        merge_upsert(spark, df, str(tmp_path / "s"))
    assert not store.store_exists(spark, str(tmp_path / "s"))


def test_store_writes_few_files(spark, tmp_path):
    df = spark.range(0, 20_000, 1, 16).selectExpr("cast(id % 7 as int) as wave", "cast(id as string) as respondent_id")
    store.write_partitioned(df, str(tmp_path / "s"))
    files = [f for _, _, fs in os.walk(tmp_path / "s") for f in fs if f.endswith(".parquet")]
    assert 7 <= len(files) <= 14


def test_latest_per_key_keeps_rows_without_an_order_value(spark):
    df = spark.createDataFrame([("a", None, 5), ("b", None, 1), ("b", 2, 7), ("b", 1, 9), (None, 1, 3), ("c", 4, None)], "k string, t int, v int")
    got = sorted((tuple(r) for r in latest_per_key(df, ["k"], "t").collect()), key=str)
    assert got == [("a", None, 5), ("b", 2, 7), ("c", 4, None), (None, 1, 3)]
    ties = spark.createDataFrame([("a", 1, v) for v in range(50)], "k string, t int, v int")
    assert len({tuple(latest_per_key(ties.repartition(n, "v"), ["k"], "t").first()) for n in (1, 3, 8)}) == 1


def test_as_of_has_one_rule_for_nulls_and_repeats(spark):
    rows = [(0, 1, "a", 10), (0, 1, "a", 11), (0, 1, None, 1), (0, 1, None, 2), (0, 2, "b", 3), (1, 1, "a", 20), (2, 2, "b", 30), (2, None, "n", 4)]
    changes = spark.createDataFrame(rows, "change int, wave int, id string, v int")

    def state(upto):
        return sorted(((r["wave"], r["id"], r["v"]) for r in as_of(changes, ["wave", "id"], "change", upto).collect()), key=str)
    assert [r for r in state(0) if r[1] != "a"] == [(1, None, 1), (1, None, 2), (2, "b", 3)] and len(state(0)) == 4
    assert state(1) == [(1, "a", 20), (1, None, 1), (1, None, 2), (2, "b", 3)]
    assert state(None) == [(1, "a", 20), (1, None, 1), (1, None, 2), (2, "b", 30), (None, "n", 4)]
    assert as_of(changes, ["wave", "id"], "change").columns == ["wave", "id", "v"]


def test_merge_frames(spark):
    t = spark.createDataFrame([(1, "a", 1), (1, "b", 1), (1, None, 1)], "wave int, respondent_id string, v int")
    s = spark.createDataFrame([(1, "a", 2), (1, None, 2)], "wave int, respondent_id string, v int")
    got = merge_frames(t, s, ["wave", "respondent_id"])
    assert "hint" not in got._jdf.queryExecution().analyzed().toString().lower()
    assert sorted((tuple(r) for r in got.collect()), key=str) == [(1, "a", 2), (1, "b", 1), (1, None, 1), (1, None, 2)]


def test_drifting_headers_are_not_misaligned(spark, tmp_path):
    raw = tmp_path / "raw"
    raw.mkdir()
    with open(raw / "a.csv", "w") as fh:
        fh.write("respondent_id,wave,nps,region\nA1,1,9,N\nA2,1,3,S\n")
    with open(raw / "b.csv", "w") as fh:
        fh.write("region, Wave ,nps_score,respondent_id,extra\nNorth,2,10,B1,zz\n\"South\",2,0,B2,zz\n")
    with open(raw / "c.csv", "w") as fh:
        fh.write("respondent_id,wave,nps,region\nC1,3,8,E\n")
    with open(raw / "notes.txt", "w") as fh:
        fh.write("ignored\n")
    cfg = TrackerConfig(rename_map={"nps": "nps_score"}, region_map={"N": "North", "S": "South", "E": "East"})
    assert [os.path.basename(f) for f in discover_wave_files(spark, str(raw))] == ["a.csv", "b.csv", "c.csv"]
    clean, rejects = ingest_waves(spark, str(raw), cfg)
    got = sorted((r["respondent_id"], r["wave"], r["region"], r["nps_score"]) for r in clean.collect())
    assert got == [("A1", 1, "North", 9), ("A2", 1, "South", 3), ("B1", 2, "North", 10),
                   ("B2", 2, "South", 0), ("C1", 3, "East", 8)]
    assert rejects.count() == 0
    only, _ = ingest_waves(spark, str(raw), cfg, only_waves=[2])
    assert only.count() == 2


def test_no_files_raises(spark, tmp_path):
    (tmp_path / "empty").mkdir()
    with open(tmp_path / "empty" / "x.txt", "w") as fh:
        fh.write("a\n")
    with pytest.raises(FileNotFoundError):
        ingest_waves(spark, str(tmp_path / "empty"))


def test_merge_upsert_parquet(spark, tmp_path):
    path = str(tmp_path / "store")
    schema = "wave int, respondent_id string, v int"
    merge_upsert(spark, spark.createDataFrame([(1, "a", 1), (1, "b", 1), (2, "c", 1)], schema), path)
    touched = merge_upsert(spark, spark.createDataFrame([(1, "a", 2), (3, "d", 2)], schema), path)
    assert touched == [1, 3]
    got = sorted((r["wave"], r["respondent_id"], r["v"]) for r in spark.read.parquet(path).collect())
    assert got == [(1, "a", 2), (1, "b", 1), (2, "c", 1), (3, "d", 2)]
    merge_upsert(spark, spark.createDataFrame([(1, "a", 2), (3, "d", 2)], schema), path)
    assert spark.read.parquet(path).count() == 4
    with pytest.raises(DuplicateKeyError):
        merge_upsert(spark, spark.createDataFrame([(1, "a", 3), (1, "a", 4)], schema), path)
    merge_upsert(spark, spark.createDataFrame([(1, "a", 3), (1, "a", 4)], schema), path,
                 on_duplicate="latest", order_col="v")
    assert {r["respondent_id"]: r["v"] for r in spark.read.parquet(path).where("wave = 1").collect()} == \
        {"a": 4, "b": 1}


def test_upsert_waves_recomputes_wave_features(spark, tmp_path):
    path = str(tmp_path / "resp")
    cols = ("respondent_id string, wave int, fieldwork_date string, region string, age_group string, "
            "weight double, nps_score int, satisfaction int, aware int, brand_used string")
    row = lambda rid, w, wt: (rid, w, None, "N", None, wt, 9, 4, 1, None)
    upsert_waves(spark, spark.createDataFrame([row("a", 1, 1.0), row("b", 1, 3.0)], cols), path)
    upsert_waves(spark, spark.createDataFrame([row("c", 1, 2.0), row("a", 1, 4.0)], cols), path)
    got = {r["respondent_id"]: r["weight_norm"] for r in read_store(spark, path).collect()}
    assert got == {"a": 4.0 / 3.0, "b": 1.0, "c": 2.0 / 3.0}


def test_keep_raw_across_header_groups_and_csv_options(spark, tmp_path):
    raw = tmp_path / "raw"
    raw.mkdir()
    with open(raw / "a.csv", "w") as fh:
        fh.write("respondent_id;wave;nps\nA;1;99\nB;1;9\n")
    with open(raw / "b.csv", "w") as fh:
        fh.write("wave;respondent_id;brand_used;weight\n2;C;X;-3\n")
    cfg = TrackerConfig(rename_map={"nps": "nps_score"})
    clean, rejects = ingest_waves(spark, str(raw), cfg, keep_raw=True, keep_source=True, csv_options={"sep": ";"})
    got = sorted((r["respondent_id"], r["reject_reason"], r["raw"]["nps_score"], r["raw"]["weight"],
                  os.path.basename(r["source_file"])) for r in rejects.collect())
    assert got == [("A", "nps_score out of range 0-10", "99", None, "a.csv"),
                   ("C", "weight not positive", None, "-3", "b.csv")]
    assert [r["respondent_id"] for r in clean.collect()] == ["B"]


def test_public_api_imports():
    import trackframe

    for name in trackframe.__all__:
        assert hasattr(trackframe, name), name


def test_replace_table_drops_waves_gone_from_input(spark, tmp_path):
    raw, out = tmp_path / "raw", str(tmp_path / "out")
    deliver(raw, "1.csv", *sheets(1, a=5))
    w2 = deliver(raw, "2.csv", *sheets(2, a=5))
    run_tracker(spark, TrackerConfig(), str(raw), out)
    os.remove(w2)
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        run_tracker(spark, TrackerConfig(), str(raw), out)
        assert existing_waves(spark, output_paths(out)[0]) == [1, 2]     # default: stale wave stays
        run_tracker(spark, TrackerConfig(), str(raw), out, replace="table")
        assert existing_waves(spark, output_paths(out)[0]) == [1]
    finally:
        spark.conf.unset("spark.sql.sources.partitionOverwriteMode")


def test_header_edge_cases(spark, tmp_path):
    from trackframe.sources.ingest import parse_header

    assert parse_header('﻿"respondent_id", wave ,,wave\r') == ("respondent_id", "wave", "_c2", "wave_2")
    raw = tmp_path / "raw"
    raw.mkdir()
    with open(raw / "bom.csv", "wb") as fh:
        fh.write('﻿respondent_id,"wave",nps_score\r\nA,1,9\r\nB,1,3\r\n'.encode("utf-8"))
    with open(raw / "empty.csv", "w") as fh:
        fh.write("")
    clean, rejects = ingest_waves(spark, str(raw))
    assert sorted((r["respondent_id"], r["wave"], r["nps_score"]) for r in clean.collect()) == [("A", 1, 9), ("B", 1, 3)]
    assert rejects.count() == 0


def test_upsert_leaves_no_staged_copies(spark, tmp_path):
    import glob

    from trackframe.session import shared_dir

    root = shared_dir(spark).replace("file:", "")
    before = set(glob.glob(f"{root}/trackframe-source-*") + glob.glob(f"{root}/trackframe-merged-*"))
    path = str(tmp_path / "store")
    schema = "wave int, respondent_id string, v int"
    merge_upsert(spark, spark.createDataFrame([(1, "a", 1)], schema), path)
    merge_upsert(spark, spark.createDataFrame([(1, "a", 2), (2, "b", 2)], schema), path)
    after = set(glob.glob(f"{root}/trackframe-source-*") + glob.glob(f"{root}/trackframe-merged-*"))
    assert after == before
    assert spark.read.parquet(path).count() == 2


def test_multi_split_files_keep_header_and_every_row(spark, tmp_path):
    raw = tmp_path / "raw"
    raw.mkdir()
    with open(raw / "big.csv", "w") as fh:
        fh.write("wave,nps_score,respondent_id,region\n")
        for i in range(6000):
            fh.write(f"{1 + i % 3},{i % 11},R{i:05d},North\n")
    with open(raw / "other.csv", "w") as fh:
        fh.write("respondent_id,wave\nZ1,4\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16k")
    try:
        clean, rejects = ingest_waves(spark, str(raw))
        got = clean.groupBy("wave").count().collect()
        assert {r["wave"]: r["count"] for r in got} == {1: 2000, 2: 2000, 3: 2000, 4: 1}
        assert clean.select("respondent_id").distinct().count() == 6001
        assert rejects.count() == 0
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_create_store_rolls_back_duplicates(spark, tmp_path):
    from trackframe.sources.store import store_exists

    path = str(tmp_path / "store")
    schema = "wave int, respondent_id string, v int"
    with pytest.raises(DuplicateKeyError):
        merge_upsert(spark, spark.createDataFrame([(1, "a", 1), (1, "a", 2)], schema), path)
    assert not store_exists(spark, path)
    assert merge_upsert(spark, spark.createDataFrame([(2, "a", 1), (None, "b", 1)], schema), path) == [2, None]


def test_leading_blank_lines_before_header(spark, tmp_path):
    raw = tmp_path / "raw"
    raw.mkdir()
    with open(raw / "w.csv", "w") as fh:
        fh.write("\n  \nrespondent_id,wave,nps_score\nA,1,9\n\nB,1,3\n")
    clean, rejects = ingest_waves(spark, str(raw))
    assert sorted((r["respondent_id"], r["nps_score"]) for r in clean.collect()) == [("A", 9), ("B", 3)]
    assert rejects.count() == 0
