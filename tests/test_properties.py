"""
the two custom operators against plain Python definitions."""

from __future__ import annotations

import os

import pytest
from conftest import null_first, rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from zonelake.operators.dedup import keep_latest
from zonelake.operators.numbering import number_rows
from zonelake.plans import refine
from zonelake.plans.registry import _accel_trusted, _customer_trusted, _step_trusted

SF = "/root/testdata/sf0.001"
needs_data = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")


@pytest.fixture(scope="module")
def tables(spark):
    customers = _customer_trusted(spark, SF)
    return customers, _accel_trusted(spark, SF, customers), _step_trusted(spark, SF, customers)


@needs_data
@pytest.mark.parametrize("which,key", [(1, "user"), (2, "serialnumber")])
def test_rn_unique_and_dense_from_one(tables, which, key):
    df = tables[which]
    per_key = df.groupBy(key).agg(
        F.count(F.lit(1)).alias("n"), F.min("rn").alias("lo"), F.max("rn").alias("hi"),
        F.countDistinct("rn").alias("d"),
    )
    bad = per_key.where("lo != 1 or hi != n or d != n").count()
    assert bad == 0


@needs_data
def test_curated_subset_and_semi_join_equivalence(tables):
    customers, accel, _ = tables
    curated = refine.customer_curated(accel, customers)
    assert curated.exceptAll(customers.select(*curated.columns)).count() == 0
    joined = accel.join(customers, F.col("user") == F.col("email")).select(*curated.columns)
    assert rows(keep_latest(joined, "serialnumber", "registrationdate")) == rows(curated)


def _python_numbering(data):
    ordered = sorted(data, key=lambda r: null_first(r))
    out, seen = [], {}
    for r in ordered:
        seen[r[0]] = seen.get(r[0], 0) + 1
        out.append((*r, seen[r[0]]))
    return sorted(out, key=null_first)


small_rows = st.lists(
    st.tuples(st.sampled_from([None, 0, 1, 2]), st.sampled_from([None, 5, 6, 7]), st.sampled_from(["a", "b", None])),
    min_size=0,
    max_size=40,
)


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(data=small_rows, hot=st.sampled_from([0, 3, 10**6]), parts=st.sampled_from([1, 3, 8]))
def test_number_rows_random(spark, data, hot, parts):
    df = spark.createDataFrame(data, "k int, t int, v string")
    got = number_rows(df, "k", "t", hot_rows=hot, partitions=parts, chunk_rows=2)
    assert rows(got) == _python_numbering(data)


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(data=small_rows)
def test_keep_latest_random(spark, data):
    df = spark.createDataFrame(data, "k int, t int, v string")
    best = {}
    for r in data:
        cand = null_first((r[1], r[2]))
        if r[0] not in best or cand > null_first((best[r[0]][1], best[r[0]][2])):
            best[r[0]] = r
    assert rows(keep_latest(df, "k", "t")) == sorted(best.values(), key=null_first)


log_rows = st.lists(
    st.tuples(
        st.sampled_from(["a", "b", "c"]),
        st.sampled_from([None, 1, 2]),
        st.sampled_from([None, "x", "y"]),
        st.integers(min_value=1, max_value=4),
        st.booleans(),
    ),
    min_size=1,
    max_size=25,
)


def _model_latest(log, as_of=None, after=None):
    best = {}
    for k, o, v, c, d in log:
        if (as_of is not None and c > as_of) or (after is not None and c <= after):
            continue
        rank = null_first((c, o, v, d))
        if k not in best or rank > null_first(best[k][1:]):
            best[k] = (k, c, o, v, d)
    return best


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(log=log_rows, as_of=st.sampled_from([None, 1, 2, 3]))
def test_snapshot_and_changes_match_model(spark, log, as_of):
    from zonelake.sinks import changelog

    df = spark.createDataFrame(
        [(k, o, v, c, d) for k, o, v, c, d in log], "k string, o int, v string, _commit long, _deleted boolean"
    )
    got = rows(changelog.snapshot(df, "k", "o", as_of=as_of))
    want = sorted(((k, o, v) for k, c, o, v, d in _model_latest(log, as_of=as_of).values() if not d), key=null_first)
    assert got == want
    changed = rows(changelog.changes_since(df, "k", "o", 2), "k", "o", "v", "_commit", "_deleted")
    want_changed = sorted(((k, o, v, c, d) for k, c, o, v, d in _model_latest(log, after=2).values()), key=null_first)
    assert changed == want_changed
