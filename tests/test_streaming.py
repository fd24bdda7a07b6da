"""Streaming ingest: two drops of files, partial waves, replay safety."""

from __future__ import annotations

import os

import pytest

from conftest import deliver, sheets
from trackframe.config import TrackerConfig
from trackframe.plans.run import output_paths, run_tracker
from trackframe.sources.store import read_store


def test_stream_two_drops_recomputes_partial_waves(spark, tmp_path):
    from trackframe.streaming import stream_waves

    land, out = tmp_path / "landing", str(tmp_path / "out")
    deliver(land, "w1 a.csv", *sheets(1, A=9, B=3))
    q = stream_waves(spark, str(land / "*.csv"), out, TrackerConfig())
    q.awaitTermination()
    # Second drop: more rows of wave 1 (one replacing A) and a new wave, plus a reject.
    deliver(land, "w1 b.csv", *sheets(1, A=10, C=0))
    with open(land / "w2.csv", "w") as fh:
        fh.write("respondent_id,wave,weight,nps_score\nD,2,2.0,9\nE,2,-1,9\n")
    stream_waves(spark, str(land / "*.csv"), out, TrackerConfig()).awaitTermination()
    resp, metrics, rejects = output_paths(out)
    got = {r["respondent_id"]: (r["wave"], r["nps_score"], r["weight_norm"]) for r in read_store(spark, resp).collect()}
    assert got == {"A": (1, 10, 1.0), "B": (1, 3, 1.0), "C": (1, 0, 1.0), "D": (2, 9, 1.0)}
    assert spark.read.parquet(rejects).count() == 1
    m = {r["wave"]: r["n"] for r in spark.read.parquet(metrics).collect()}
    assert m == {1: 3, 2: 1}
    # A third run with no new files changes nothing.
    stream_waves(spark, str(land / "*.csv"), out, TrackerConfig()).awaitTermination()
    assert read_store(spark, resp).count() == 4
    assert os.path.isdir(os.path.join(out, "_checkpoint"))


def test_batch_run_on_a_streamed_output(spark, tmp_path):
    from trackframe.streaming import stream_waves

    land, out = tmp_path / "landing", str(tmp_path / "out")
    deliver(land, "one.csv", *sheets(1, A=9), {"respondent_id": "B", "wave": "1", "nps_score": "55"})
    stream_waves(spark, str(land / "*.csv"), out, TrackerConfig()).awaitTermination()
    deliver(land, "two.csv", *sheets(2, C=3), {"respondent_id": "D", "wave": "", "nps_score": "5"})
    run = run_tracker(spark, TrackerConfig(), str(land), out, incremental=True)
    assert run.waves_processed == [2]
    rejected = spark.read.parquet(output_paths(out)[2]).collect()
    assert sorted(r["respondent_id"] for r in rejected) == ["B", "D"]


def test_duplicate_key_in_a_batch_is_an_error(spark, tmp_path):
    from trackframe.operators.upsert import DuplicateKeyError
    from trackframe.streaming.waves import process_files

    path = deliver(tmp_path / "landing", "w.csv", *sheets(1, A=9), *sheets(1, A=2))
    with pytest.raises(DuplicateKeyError):
        process_files(spark, [path], str(tmp_path / "out"), TrackerConfig())
