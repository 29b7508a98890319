"""Every registered query against its DuckDB formulation (sf0.001), plus the
driver contract."""

from __future__ import annotations

import os

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from tools.check_oracle import compare
from zonelake.plans.registry import ORACLE_SQL, QUERIES

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")


def test_every_query_has_an_oracle():
    assert set(ORACLE_SQL) == set(QUERIES)
    assert set(oracle_sql()) <= set(queries())


def test_entry_smoke(spark):
    df = entry(spark)
    assert df.columns == ["email", "sensorreadingtime", "serialnumber", "distancefromobject", "x", "y", "z", "rn"]
    assert df.count() > 0


def test_queries_match_oracle(spark):
    results = compare(spark, SF, list(QUERIES))
    failed = [r for r in results if not r["ok"]]
    assert not failed, failed


def test_hot_paths_on_test_tables_match_oracle(spark, monkeypatch):
    """Every user and device over 30 rows is treated as hot: the gate splits
    them off and the numbering takes the range path, on the real tables."""
    import zonelake.operators.joins as joins
    import zonelake.operators.skew as skew

    monkeypatch.setattr(skew, "HOT_ROWS", 30)
    monkeypatch.setattr(joins, "BROADCAST_KEYS", 0)
    results = compare(spark, SF, ["accelerometer_trusted", "step_trainer_trusted", "customer_curated", "ml_curated"])
    failed = [r for r in results if not r["ok"]]
    assert not failed, failed
