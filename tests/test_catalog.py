"""Every registered query against its DuckDB oracle on the smallest driver tables."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from oracle_check import compare, duck
from trackframe.plans.catalog import ORACLE_SQL, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_every_query_has_an_oracle():
    assert set(ORACLE_SQL) == set(QUERIES) <= set(entry.queries())


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert "nps_rank_in_wave" in df.columns


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    ok, msg = compare(spark, con, name, QUERIES[name], ORACLE_SQL[name], SF)
    assert ok, msg
