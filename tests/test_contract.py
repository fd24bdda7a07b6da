"""Contract enforcement: fill, cast, reasons, priority, strict parsing."""

from __future__ import annotations

from trackframe.operators.contract import CANONICAL_COLUMNS, enforce_contract, tag_rows

COLS = ["respondent_id", "wave", "region", "age_group", "weight", "nps_score", "satisfaction", "aware"]
GOOD = dict(zip(COLS, ("p-1", "4", "Isles", "65+", "0.25", "0", "1", "0")))
# One broken answer each, with the reason it must give; None: the edges that are still fine.
CASES = [({}, None), ({"nps_score": "10", "satisfaction": "5", "aware": "1"}, None), ({"weight": None, "nps_score": None, "aware": None}, None),
         ({"nps_score": "-1"}, "nps_score out of range 0-10"), ({"nps_score": "11"}, "nps_score out of range 0-10"),
         ({"satisfaction": "0"}, "satisfaction out of range 1-5"), ({"satisfaction": "6"}, "satisfaction out of range 1-5"),
         ({"aware": "2"}, "aware not in {0,1}"), ({"weight": "0"}, "weight not positive"), ({"respondent_id": None}, "missing respondent_id")]


def test_each_rule_at_its_edges(spark):
    rows = [tuple({**GOOD, "age_group": str(i), **change}[c] for c in COLS) for i, (change, _) in enumerate(CASES)]
    clean, rejects = enforce_contract(spark.createDataFrame(rows, ", ".join(f"{c} string" for c in COLS)))
    want = {str(i): reason for i, (_, reason) in enumerate(CASES)}
    assert {r["age_group"]: None for r in clean.collect()} == {k: v for k, v in want.items() if v is None}
    assert {r["age_group"]: r["reject_reason"] for r in rejects.collect()} == {k: v for k, v in want.items() if v is not None}


def test_outputs_have_the_contract_layout(spark):
    clean, rejects = enforce_contract(spark.createDataFrame([("p-1", "4")], ["respondent_id", "wave"]))
    assert clean.columns == CANONICAL_COLUMNS and rejects.columns == [*CANONICAL_COLUMNS, "reject_reason"]
    kinds = {"wave": "int", "nps_score": "int", "satisfaction": "int", "aware": "int", "weight": "double"}
    assert dict(clean.dtypes) == {c: kinds.get(c, "string") for c in CANONICAL_COLUMNS}
    assert [v for v in clean.first() if v is not None] == ["p-1", 4]


def test_priority_and_missing_wave(spark):
    rows = [("A", None, "x", "x", "-1", "99", "9", "5"),      # wave first
            ("B", "2", "x", "x", "-1", "99", "9", "5"),       # nps before satisfaction/aware/weight
            ("C", "2", "x", "x", "-1", "5", "9", "5"),
            ("D", "2", "x", "x", "-1", "5", "3", "5"),
            ("E", "2", "x", "x", "-1", "5", "3", "1")]
    _, rejects = enforce_contract(spark.createDataFrame(rows, COLS))
    got = {r["respondent_id"]: r["reject_reason"] for r in rejects.collect()}
    assert got == {"A": "missing wave", "B": "nps_score out of range 0-10",
                   "C": "satisfaction out of range 1-5", "D": "aware not in {0,1}",
                   "E": "weight not positive"}


def test_unparseable_text_is_tolerated_unless_strict(spark):
    rows = [("R1", "1", "x", "x", "abc", "9.7", " 4 ", "1"),
            ("R2", "1", "x", "x", "1.0", "1e1", "4", "1")]
    df = spark.createDataFrame(rows, COLS)
    clean, rejects = enforce_contract(df)
    got = {r["respondent_id"]: r for r in clean.collect()}
    assert rejects.count() == 0
    assert got["R1"]["weight"] is None and got["R1"]["nps_score"] == 9 and got["R1"]["satisfaction"] == 4
    assert got["R2"]["nps_score"] is None
    tagged = tag_rows(df, strict_parse=True)
    reasons = {r["respondent_id"]: r["reject_reason"] for r in tagged.collect()}
    assert reasons == {"R1": "weight not parseable", "R2": "nps_score not parseable"}


def test_non_finite_weight_rejected(spark):
    rows = [("R1", "1", "x", "x", "NaN", "9", "4", "1"), ("R2", "1", "x", "x", "Infinity", "9", "4", "1")]
    _, rejects = enforce_contract(spark.createDataFrame(rows, COLS))
    assert {r["reject_reason"] for r in rejects.collect()} == {"weight not positive"}


def test_header_case_and_padding(spark):
    df = spark.createDataFrame([("R1", "3", "5")], ["respondent_id", " Wave", "NPS_SCORE"])
    clean, _ = enforce_contract(df)
    row = clean.collect()[0]
    assert row["wave"] == 3 and row["nps_score"] == 5


def test_typed_input_passes_through(spark):
    df = spark.createDataFrame([("R1", 1, 1.5, 10)], "respondent_id string, wave int, weight double, nps_score int")
    clean, rejects = enforce_contract(df)
    assert rejects.count() == 0
    assert clean.collect()[0]["weight"] == 1.5
