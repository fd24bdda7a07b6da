"""Configuration checks and text-cast parity."""

from __future__ import annotations

import pytest

from trackframe.config import ConfigError, TrackerConfig
from trackframe.functions.casts import lenient_double, lenient_int
from trackframe.operators.contract import tag_rows


def test_from_mapping_defaults_and_coercion():
    assert TrackerConfig.from_mapping(None) == TrackerConfig()
    cfg = TrackerConfig.from_mapping({
        "harmonise": {"rename": {"nps": "nps_score"}, "region": {1: "North"}, "recode": {"age_group": {"a": "b"}}},
        "segment_cols": [],
        "metrics": {"promoter_min": "8"},
        "options": {"zero_fill": True},
    })
    assert cfg.region_map == {"1": "North"} and cfg.segment_cols == ("region",)
    assert cfg.promoter_min == 8 and cfg.zero_fill
    assert cfg.value_maps() == {"age_group": {"a": "b"}, "region": {"1": "North"}}


@pytest.mark.parametrize("raw", [[1], {"harmonise": {"rename": ["x"]}}, {"segment_cols": "region"},
                                 {"harmonise": {"recode": {"a": 1}}}, {"metrics": [1]}, {"metrics": {"promoter_min": "x"}},
                                 {"options": {"zero_fill": "yes"}}])
def test_from_mapping_rejects_bad_structure(raw):
    with pytest.raises(ConfigError):
        TrackerConfig.from_mapping(raw)


def test_fingerprint_tells_configurations_apart():
    one = TrackerConfig(rename_map={"a": "b"})
    assert one.fingerprint() == TrackerConfig(rename_map={"a": "b"}).fingerprint() != TrackerConfig(zero_fill=True).fingerprint()


def test_lenient_int_matches_non_ansi_cast(spark):
    cases = ["9", " 9 ", "9.7", "-3.2", "1e1", "abc", "", None, "3000000000", "+4", "007"]
    df = spark.createDataFrame([(c,) for c in cases], "t string")
    got = [r[0] for r in df.select(lenient_int(df.t)).collect()]
    assert got == [9, 9, 9, -3, None, None, None, None, None, 4, 7]


def test_lenient_double(spark):
    df = spark.createDataFrame([("1.5",), (" 2 ",), ("x",), ("1e3",)], "t string")
    assert [r[0] for r in df.select(lenient_double(df.t)).collect()] == [1.5, 2.0, None, 1000.0]


def test_keep_raw_keeps_original_text(spark):
    df = spark.createDataFrame([("R1", "1", "99", "n/a")], ["respondent_id", "wave", "nps_score", "weight"])
    row = tag_rows(df, keep_raw=True).collect()[0]
    assert row["reject_reason"] == "nps_score out of range 0-10"
    assert row["raw"]["nps_score"] == "99" and row["raw"]["weight"] == "n/a"


def test_from_yaml(tmp_path):
    p = tmp_path / "tracker.yaml"
    p.write_text("harmonise:\n  rename:\n    nps: nps_score\n  region:\n    N: North\n"
                 "segment_cols: [region, age_group]\nmetrics:\n  top2box_min: 5\n")
    cfg = TrackerConfig.from_yaml(str(p))
    assert cfg.rename_map == {"nps": "nps_score"} and cfg.segment_cols == ("region", "age_group")
    assert cfg.top2box_min == 5 and cfg.promoter_min == 9
    (tmp_path / "empty.yaml").write_text("")
    assert TrackerConfig.from_yaml(str(tmp_path / "empty.yaml")) == TrackerConfig()
