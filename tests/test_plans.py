"""Physical-plan properties that the design relies on at scale."""

from __future__ import annotations

import contextlib
import io
import re

from trackframe.operators.contract import enforce_contract
from trackframe.operators.features import normalise_weights
from trackframe.plans.catalog import QUERIES
from trackframe.plans.views import orders_tracker, orders_tracker_raw

SF = "/root/testdata/sf0.001"


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_weight_norm_uses_partial_means_and_no_window(spark):
    df = normalise_weights(orders_tracker(spark, SF))
    plan = plan_of(df)
    assert "Window" not in plan and "partial_avg" in plan
    assert "hint" not in df._jdf.queryExecution().analyzed().toString().lower()


def test_segment_counts_need_no_means(spark):
    for name in ("nps_segment_counts", "top2box_counts"):
        plan = plan_of(QUERIES[name](spark, SF))
        assert "avg(" not in plan and "ExistingRDD" not in plan


def test_flagship_prunes_columns_and_aggregates_partially(spark):
    df = QUERIES["wave_metrics"](spark, SF)
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    formatted = buf.getvalue()
    assert "ReadSchema: struct<c_custkey:bigint,c_nationkey:int>" in formatted
    assert "o_orderpriority" not in formatted.split("ReadSchema: struct<o_orderkey")[1].split("\n")[0]
    assert "partial_sum" in formatted and "partial_count" in formatted


def test_contract_split_is_not_pushed_into_the_casts(spark):
    clean, _ = enforce_contract(orders_tracker_raw(spark, SF))
    plan = plan_of(clean)
    assert "Generate explode" in plan
    filters = [line for line in plan.splitlines() if "Filter" in line]
    assert not any("try_cast" in line for line in filters)


def test_change_table_state_is_one_aggregate(spark):
    plan = plan_of(QUERIES["read_latest_version"](spark, SF))
    assert "Join" not in plan and "partial_max_by" in plan


def test_flagship_is_one_aggregation_pass(spark):
    plan = plan_of(QUERIES["wave_metrics"](spark, SF))
    assert "ExistingRDD" not in plan                    # no materialised per-wave lookup
    aggregates = [line for line in plan.splitlines() if "HashAggregate(" in line]
    assert len(aggregates) == 2 and sum("partial_count" in line for line in aggregates) == 1
