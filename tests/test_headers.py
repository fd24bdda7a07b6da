"""Header job and header dictionary: few tasks for many files, one scan for many headers."""

from __future__ import annotations

import gzip
import re

from trackframe.config import TrackerConfig
from trackframe.sources import ingest
from trackframe.sources.ingest import header_dictionary, ingest_tagged, ingest_waves, wave_file_headers


def test_five_thousand_files_take_few_header_tasks(spark, tmp_path):
    raw = tmp_path / "raw"
    raw.mkdir()
    for i in range(5000):
        (raw / f"{i}.csv").write_text(f"respondent_id,wave\nr{i},{1 + i % 3}\n")
    spark.sparkContext.setJobGroup("headers", "headers")
    try:
        headers = wave_file_headers(spark, str(raw))
    finally:
        spark.sparkContext.setJobGroup("", "")
    tracker = spark.sparkContext.statusTracker()
    stages = {s for j in tracker.getJobIdsForGroup("headers") for s in tracker.getJobInfo(j).stageIds}
    infos = [tracker.getStageInfo(s) for s in stages]
    # Spark lists large folders by a job of its own; the header job is the one that writes.
    assert max(i.numTasks for i in infos if i and "parquet" in i.name) <= 64
    assert headers.count() == 5000 and [r[0] for r in headers.select("header").distinct().collect()] == ["respondent_id,wave"]


def test_plan_does_not_grow_with_headers(spark, tmp_path):
    sizes, counts = [], []
    for n in (2, 200):
        raw = tmp_path / f"raw{n}"
        raw.mkdir()
        for i in range(n):
            names = ["wave", f"x{i}", "respondent_id"]
            row = ["1", "e", f"r{i}"]
            names, row = names[i % 3:] + names[:i % 3], row[i % 3:] + row[:i % 3]
            (raw / f"{i}.csv").write_text(",".join(names) + "\n" + ",".join(row) + "\n")
        tagged = ingest_tagged(spark, str(raw))
        plan = tagged._jdf.queryExecution().optimizedPlan().toString()
        sizes.append(len(plan.splitlines()))
        counts.append(sorted(r["respondent_id"] for r in tagged.where("reject_reason IS NULL AND wave = 1").collect()))
        assert len(re.findall(r"Relation.*csv", plan)) == 1
    assert sizes[0] == sizes[1] and [len(c) for c in counts] == [2, 200] and counts[1] == sorted(f"r{i}" for i in range(200))


def test_dictionary_applies_renames_and_loose_names():
    cfg = TrackerConfig(rename_map={"NPS ": "nps_score"})
    found = header_dictionary([' Wave ,nps,"respondent_id"', "wave,wave,x", ""], cfg, ["respondent_id", "wave", "nps_score"])
    assert found == {' Wave ,nps,"respondent_id"': (3, [2, 0, 1]), "wave,wave,x": (3, [None, 0, None]), "": (0, [None, None, None])}


def test_rows_longer_and_shorter_than_their_header(spark, tmp_path):
    raw = tmp_path / "raw"
    raw.mkdir()
    (raw / "a.csv").write_text("wave,respondent_id\n1,a,spare,more\n2\n3,c\n")
    (raw / "b.csv").write_text("respondent_id,region,age_group,wave,nps_score\nd,N,,4,5\n")
    clean, rejects = ingest_waves(spark, str(raw))
    assert sorted((r["respondent_id"], r["wave"], r["region"], r["nps_score"]) for r in clean.collect()) == [("a", 1, None, None), ("c", 3, None, None), ("d", 4, "N", 5)]
    assert [r["reject_reason"] for r in rejects.collect()] == ["missing respondent_id"]


def test_long_header_odd_line_ends_and_compression(spark, tmp_path):
    raw = tmp_path / "raw"
    raw.mkdir()
    wide = ",".join(["respondent_id", "wave", *[f"column_{i:05d}" for i in range(9000)]])  # beyond the first read
    (raw / "wide.csv").write_text(wide + "\nw,1\n")
    (raw / "mac.csv").write_bytes(b"\r\r\nwave,respondent_id\r\n2,m\r\n")
    (raw / "one.csv").write_text("respondent_id,wave")  # a header and nothing else
    with gzip.open(raw / "z.csv.gz", "wt") as fh:
        fh.write("wave,respondent_id\n3,z\n")
    clean, _ = ingest_waves(spark, str(raw), pattern="*.csv*")
    assert sorted((r["respondent_id"], r["wave"]) for r in clean.collect()) == [("m", 2), ("w", 1), ("z", 3)]


def test_stores_that_only_spark_reads(spark, tmp_path, monkeypatch):
    raw = tmp_path / "raw"
    raw.mkdir()
    (raw / "a b.csv").write_text("\nwave,respondent_id\n1,a\n")
    (raw / "b.csv").write_text("respondent_id,wave\nb,2\n")
    direct = sorted(tuple(r) for r in wave_file_headers(spark, str(raw)).collect())
    monkeypatch.setattr(ingest, "_python_reads", lambda path: False)
    assert sorted(tuple(r) for r in wave_file_headers(spark, str(raw)).collect()) == direct
    assert sorted(r["respondent_id"] for r in ingest_waves(spark, str(raw))[0].collect()) == ["a", "b"]
