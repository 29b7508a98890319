"""Operators against their plain Spark definitions."""

from __future__ import annotations

import random

import pytest
from conftest import null_first, rows
from pyspark.sql import Window
from pyspark.sql import functions as F

from zonelake.operators import joins, numbering, skew
from zonelake.operators.dedup import distinct_rows, keep_latest
from zonelake.operators.filters import consent_filter
from zonelake.operators.joins import fuse_on_time, gate
from zonelake.operators.numbering import number_rows
from zonelake.operators.projection import lower_columns
from zonelake.plans import checks


def _plain_numbering(df, by, order):
    ties = [c for c in df.columns if c not in by and c not in order]
    w = Window.partitionBy(*by).orderBy(*[F.col(c).asc_nulls_first() for c in order + ties])
    return df.withColumn("rn", F.row_number().over(w).cast("long"))


@pytest.mark.parametrize(
    "seed,chunk,parts,hot",
    [(1, 1 << 16, 8, 0), (2, 7, 3, 0), (3, 50, 16, 0), (4, 50, 8, 400), (5, 1 << 16, 8, 10**9)],
)
def test_number_rows_equals_row_number(spark, seed, chunk, parts, hot):
    rnd = random.Random(seed)
    data = []
    for _ in range(3000):
        # one hot user with ~40% of rows, a few nulls in key and order
        u = 0 if rnd.random() < 0.4 else rnd.choice([None, 1, 2, 3, 4, 5, 6, 7])
        t = rnd.choice([None, *range(40)])
        data.append((u, t, float(rnd.randint(0, 2))))
    data += [(3, 5, 1.0)] * 500  # a group of copies
    df = spark.createDataFrame(data, "u long, t long, x double")
    got = number_rows(df, "u", "t", chunk_rows=chunk, partitions=parts, hot_rows=hot)
    assert got.columns == ["u", "t", "x", "rn"]
    assert dict(got.dtypes)["rn"] == "bigint"
    assert rows(got) == rows(_plain_numbering(df, ["u"], ["t"]))


@pytest.mark.parametrize("hot", [0, 3, 10**9])
def test_number_rows_with_weight(spark, hot):
    df = spark.createDataFrame(
        [("a", 1, 3), ("a", 2, 1), ("a", 1, 0), ("b", 5, 2), ("b", 5, None)], "k string, t int, w long"
    )
    got = number_rows(df, "k", "t", weight="w", chunk_rows=2, partitions=4, hot_rows=hot)
    assert rows(got) == [("a", 1, 1), ("a", 1, 2), ("a", 1, 3), ("a", 2, 4), ("b", 5, 1), ("b", 5, 2)]


def test_number_rows_too_many_hot_keys_takes_range_path(spark, monkeypatch):
    import zonelake.operators.skew as skew

    monkeypatch.setattr(skew, "MAX_HOT_KEYS", 2)
    df = spark.createDataFrame([(k % 5, k, 1.0) for k in range(200)] + [(None, 1, 1.0)] * 3, "u long, t long, x double")
    got = number_rows(df, "u", "t", hot_rows=2, partitions=4)
    assert rows(got) == rows(_plain_numbering(df, ["u"], ["t"]))


def test_number_rows_multi_key_and_empty(spark):
    df = spark.createDataFrame([(1, "x", 3), (1, "x", 1), (1, "y", 2), (None, None, 1)], "a int, b string, t int")
    got = number_rows(df, ["a", "b"], "t", partitions=2, hot_rows=1)
    assert rows(got) == [(None, None, 1, 1), (1, "x", 1, 1), (1, "x", 3, 2), (1, "y", 2, 1)]
    empty = df.where("a > 100")
    assert number_rows(empty, "a", "t").count() == 0


def test_number_rows_rejects_bad_arguments(spark):
    df = spark.createDataFrame([(1, 2)], "a int, rn int")
    with pytest.raises(ValueError):
        number_rows(df, [], "a")
    with pytest.raises(ValueError):
        number_rows(df, "a", "missing")
    with pytest.raises(ValueError):
        number_rows(df, "a", "a", name="rn")


def test_keep_latest_breaks_ties_on_all_columns(spark):
    df = spark.createDataFrame(
        [("k", 2, "a"), ("k", 2, "b"), ("k", 1, "z"), ("j", None, "q"), ("j", 0, None), (None, 1, "n")],
        "key string, ord int, v string",
    )
    got = keep_latest(df, "key", "ord")
    assert got.columns == ["key", "ord", "v"]
    assert rows(got) == sorted([("k", 2, "b"), ("j", 0, None), (None, 1, "n")], key=null_first)


def test_keep_latest_multi_order(spark):
    df = spark.createDataFrame([(1, 1, 9, "a"), (1, 2, 0, "b"), (1, 2, 1, "c")], "k int, c int, o int, v string")
    assert rows(keep_latest(df, ["k"], ["c", "o"])) == [(1, 2, 1, "c")]


def test_distinct_rows(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (2, None), (2, None)], "a int, b string")
    assert rows(distinct_rows(df)) == [(1, "a"), (2, None)]


def test_lower_columns_and_collision(spark):
    df = spark.createDataFrame([(1, 2)], "serialNumber int, `a.B` int")
    assert lower_columns(df).columns == ["serialnumber", "a.b"]
    clash = spark.createDataFrame([(1, 2)], "User int, uSer int")
    with pytest.raises(ValueError):
        lower_columns(clash)


def test_consent_filter_checks_presence_only(spark):
    df = spark.createDataFrame([(1, 0), (2, None), (3, 99999999999)], "id int, sharewithresearchasofdate long")
    assert rows(consent_filter(df), "id") == [(1,), (3,)]
    plan = consent_filter(df.select("id", "sharewithresearchasofdate"))._jdf.queryExecution().optimizedPlan().toString()
    assert "isnotnull" in plan


def test_gate_counts_and_expands(spark):
    readings = spark.createDataFrame([("a", 1), ("a", 2), ("b", 1), (None, 1)], "user string, t int")
    customers = spark.createDataFrame([("a", "s1"), ("a", "s2"), ("c", "s3"), (None, "s4")], "email string, sn string")
    weighted = gate(readings, customers, "user", "email", weight="w")
    assert rows(weighted) == [("a", 1, 2), ("a", 2, 2)]
    expanded = gate(readings, customers, "user", "email")
    plain = readings.join(customers, F.col("user") == F.col("email")).select("user", "t")
    assert rows(expanded) == rows(plain)


def test_gate_splits_hot_keys(spark, monkeypatch):
    import zonelake.operators.joins as joins
    from zonelake.operators.skew import find_hot_keys

    monkeypatch.setattr(joins, "BROADCAST_KEYS", 0)  # force the shuffled path
    readings = spark.createDataFrame(
        [("a", t) for t in range(60)] + [("b", 1), ("c", 2), (None, 3)], "user string, t int"
    )
    customers = spark.createDataFrame([("a", "s1"), ("a", "s2"), ("b", "s3"), (None, "s4")], "email string, sn string")
    plain = readings.join(customers, F.col("user") == F.col("email")).groupBy("user", "t").count()
    expected = rows(plain.withColumnRenamed("count", "w"))
    hot = find_hot_keys(readings, ["user"], threshold=10)
    assert rows(hot.frame) == [("a",)]
    assert rows(joins.gate(readings, customers, "user", "email", weight="w", hot=hot)) == expected
    # without a given set: detection finds no key over HOT_ROWS, plain shuffled join
    assert rows(joins.gate(readings, customers, "user", "email", weight="w")) == expected
    # the shared detection counts rows x devices
    shared = joins.gate_hot_keys(readings, "user", customers, "email", threshold=100)
    assert rows(shared.frame) == [("a",)]
    assert joins.gate_hot_keys(readings, "user", customers, "email", threshold=200).frame is None


def test_more_hot_keys_than_are_broadcast(spark, monkeypatch):
    """The largest hot keys are split off; the rest is numbered and joined like other keys, with equal results."""
    import zonelake.operators.joins as joins
    import zonelake.operators.skew as skew

    readings = spark.createDataFrame([(f"k{k}", t) for k in range(20) for t in range(10 + k)], "user string, timestamp int")
    customers = spark.createDataFrame([(f"k{k}",) for k in range(0, 20, 2) for _ in range(1 + k % 3)], "email string")
    want = rows(joins.gate(readings, customers, "user", "email", weight="w"))
    ranks = rows(number_rows(readings, "user", "timestamp"))
    monkeypatch.setattr(skew, "MAX_HOT_KEYS", 5)
    monkeypatch.setattr(skew, "HOT_ROWS", 8)
    monkeypatch.setattr(joins, "BROADCAST_KEYS", 0)
    assert rows(skew.find_hot_keys(readings, ["user"]).frame) == [(f"k{k}",) for k in range(15, 20)]
    assert rows(joins.gate(readings, customers, "user", "email", weight="w")) == want
    assert rows(number_rows(readings, "user", "timestamp")) == ranks


@pytest.mark.parametrize("hot_rows", [0, 10**9])
def test_numbering_keeps_the_zeros(spark, hot_rows):
    values = [("u", 5, -0.0), ("u", 5, 0.0), ("u", 5, 0.0), ("u", 1, -0.0), ("v", 5, 0.0), ("v", 5, None)]
    frame = spark.createDataFrame(values, "user string, timestamp int, x double")
    got = sorted(number_rows(frame, "user", "timestamp", hot_rows=hot_rows).collect(), key=lambda r: (r.user, r.rn))
    assert [(r.user, r.timestamp, str(r.x)) for r in got] == [
        ("u", 1, "-0.0"), ("u", 5, "-0.0"), ("u", 5, "0.0"), ("u", 5, "0.0"), ("v", 5, "None"), ("v", 5, "0.0"),
    ]


@pytest.mark.parametrize("hot_rows", [1, 10**9])
def test_fusion_keeps_the_zeros(spark, monkeypatch, hot_rows):
    import zonelake.operators.skew as skew
    from zonelake.operators.joins import fuse_on_time

    monkeypatch.setattr(skew, "HOT_ROWS", hot_rows)
    devices = spark.createDataFrame([(7, "s", 1, "e", 1), (7, "t", 1, "e", 1)], "sensorreadingtime int, serialnumber string, distancefromobject int, email string, registrationdate int")
    accel = spark.createDataFrame([(7, x, 1.0, z, "u") for x, z in ((-0.0, 0.0), (0.0, 0.0), (0.0, 0.0), (0.0, -0.0))], "timestamp int, x double, y double, z double, user string")
    got = fuse_on_time(devices, accel).collect()
    assert sorted((r.serialnumber, str(r.x), str(r.z), r._w) for r in got) == [
        (s, x, z, n) for s in "st" for x, z, n in (("-0.0", "0.0", 1), ("0.0", "-0.0", 1), ("0.0", "0.0", 2))
    ]


@pytest.mark.parametrize("same_user", [False, True])
def test_fuse_on_time_salts_busy_instants(spark, monkeypatch, same_user):
    import zonelake.operators.skew as skew
    from zonelake.operators.joins import fuse_on_time

    devices = spark.createDataFrame(
        [(t if i % 3 else 7, f"s{i % 4}", i % 5, f"e{i % 2}", 1) for i, t in enumerate(range(40))],
        "sensorreadingtime int, serialnumber string, distancefromobject int, email string, registrationdate int",
    )
    accel = spark.createDataFrame(
        [(7 if i % 2 else i, float(i % 6), 1.0, 2.0, f"e{i % 3}") for i in range(60)] * 2,
        "timestamp int, x double, y double, z double, user string",
    )
    plain = rows(fuse_on_time(devices, accel, same_user=same_user))
    monkeypatch.setattr(skew, "HOT_ROWS", 10)
    salted = fuse_on_time(devices, accel, same_user=same_user)
    assert rows(salted) == plain
    assert len(plain) > 0
    # one device row against many tuples: the accelerometer side is split
    one = devices.where("sensorreadingtime = 7").limit(1)
    many = spark.createDataFrame(
        [(7, float(i), 1.0, 2.0, f"e{i % 2}") for i in range(40)], "timestamp int, x double, y double, z double, user string"
    )
    monkeypatch.setattr(skew, "HOT_ROWS", 10**9)
    plain_one = rows(fuse_on_time(one, many, same_user=same_user))
    monkeypatch.setattr(skew, "HOT_ROWS", 5)
    assert rows(fuse_on_time(one, many, same_user=same_user)) == plain_one


def test_number_rows_nan_key_spanning_partitions(spark):
    nan = float("nan")
    df = spark.createDataFrame([(nan, t) for t in range(40)] + [(1.0, t) for t in range(5)], "k double, t int")
    got = number_rows(df, "k", "t", hot_rows=0, partitions=6)
    ranks = sorted(r["rn"] for r in got.collect() if r["k"] != r["k"])
    assert ranks == list(range(1, 41))


def test_bounds_from_session_settings(spark):
    import zonelake.operators.joins as joins
    import zonelake.operators.skew as skew

    assert skew.hot_threshold(None, spark) == skew.HOT_ROWS
    spark.conf.set("spark.zonelake.hotRows", "7")
    spark.conf.set("spark.zonelake.broadcastKeys", "3")
    try:
        assert skew.hot_threshold(None, spark) == 7
        assert skew.hot_threshold(5, spark) == 5
        assert joins.broadcast_keys(spark) == 3
        df = spark.createDataFrame([(1,)] * 8 + [(2,)] * 2, "k int")
        assert rows(skew.find_hot_keys(df, ["k"]).frame) == [(1,)]
    finally:
        spark.conf.unset("spark.zonelake.hotRows")
        spark.conf.unset("spark.zonelake.broadcastKeys")


def test_numbering_violations(spark):
    """Repeated and missing numbers, nulls and numbers far apart, against a count per key and number."""
    from zonelake.plans.checks import assert_numbering, numbering_violations

    good = [(k, i) for k, n in (("a", 200), ("b", 1), ("c", 64), ("d", 63)) for i in range(1, n + 1)]
    frame = lambda data: spark.createDataFrame(data, "k string, rn long").repartition(3)
    assert numbering_violations(frame(good), "k", table_name="t").collect() == [("t", 0, 0, 0)]
    assert_numbering(frame(good), "k")
    bad = [r for r in good if r not in (("a", 70), ("a", 128))] + [("a", 5), ("a", 5), ("c", 64), (None, 1), ("e", None), ("f", 0), ("g", 3)]
    assert numbering_violations(frame(bad), "k").collect() == [("", 3, 3, 4)]
    with pytest.raises(ValueError, match="3 rows without key or number, 3 duplicated, 4 missing"):
        assert_numbering(frame(bad), "k")
    assert numbering_violations(frame(good).limit(0), "k").collect() == [("", 0, 0, 0)]


def test_numbering_check_moves_few_rows(spark):
    """One row for hundreds of neighbouring numbers is shuffled; repeated and missing numbers on either side of its bounds are found."""
    import re

    from zonelake.plans.checks import numbering_violations

    good = spark.range(100_000, numPartitions=2).selectExpr("id % 2 AS k", "id div 2 + 1 AS rn")
    found = numbering_violations(good, "k")
    assert found.collect() == [("", 0, 0, 0)]
    formatted = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    moved = [float(n) for n in re.findall(r"rowCount=([0-9.E+]+)", found._jdf.queryExecution().explainString(formatted))]
    assert moved and max(moved) < 100_000 / 400, moved
    bad = good.where("rn NOT IN (1, 64, 511, 512, 513, 1024, 4096)").unionByName(good.where("rn IN (63, 510, 514, 1025, 4095)"))
    assert numbering_violations(bad.repartition(3), "k").collect() == [("", 0, 10, 14)]


def test_counts_of_hot_keys_are_skipped_only_where_none_can_be(spark):
    from zonelake.operators.skew import no_hot_keys

    assert no_hot_keys(["k"], 10, spark, 10).frame is None
    assert no_hot_keys(["k"], 11, spark, 10) is None


@pytest.mark.parametrize("buckets", [1, 4, 1 << 20])
def test_hot_keys_by_hash_buckets(spark, monkeypatch, buckets):
    """Whatever shares a bucket, the hot keys are those of a plain count; weights, nulls and key tuples too."""
    import zonelake.operators.skew as skew

    monkeypatch.setattr(skew, "HASH_BUCKETS", buckets)
    data = [(None if k == 3 else f"k{k}", k % 2, 1 + k) for k in range(12) for _ in range(3 * k)]
    df = spark.createDataFrame(data, "k string, part int, w long").repartition(5)
    for keys, weight, limit in ((["k"], None, 20), (["k", "part"], None, 8), (["k"], "w", 150), (["k"], None, 33), (["part"], None, 0)):
        size = F.sum(weight) if weight else F.count(F.lit(1))
        want = rows(df.groupBy(*keys).agg(size.alias("n")).where(F.col("n") > limit).drop("n"))
        got = skew.find_hot_keys(df, keys, weight=F.col(weight) if weight else None, threshold=limit)
        assert (rows(got.frame) if got.frame else []) == want
    assert skew.find_hot_keys(df.limit(0), ["k"]).frame is None


@pytest.mark.parametrize("kind", ["string", "long", "int", "double", "date"])
def test_key_filter_drops_no_match(spark, monkeypatch, kind):
    """Rows of gate keys all pass, most others do not; a full bitmap or keys of another type filter nothing."""
    import zonelake.operators.joins as joins

    column = F.date_add(F.lit("2020-01-01").cast("date"), F.col("id").cast("int")) if kind == "date" else F.col("id").cast(kind)
    data = spark.range(20_000).select(column.alias("user"), "id").union(spark.createDataFrame([(None, -1)], f"user {kind}, id long"))
    gate_rows = data.where("id % 100 = 7 or id < 0").select(F.col("user").alias("email"))
    passed = {r.id for r in joins.may_match(data, "user", gate_rows.where("email is not null"), "email", 200).collect()}
    assert passed >= set(range(7, 20_000, 100)) and len(passed) < 20_000 / 8
    monkeypatch.setattr(joins, "BROADCAST_KEYS", 0)
    assert sorted(r.id for r in joins.gate(data, gate_rows, "user", "email").collect()) == list(range(7, 20_000, 100))
    assert joins.may_match(data, "user", gate_rows, "email", joins.FILTER_BITS) is data
    other = gate_rows.select(F.col("email").cast("string" if kind == "long" else "long" if kind == "int" else "binary" if kind == "string" else "string"))
    assert joins.may_match(data, "user", other, "email", 200) is data
    assert joins.may_match(data, "user", gate_rows.limit(0), "email", 0).count() == 0


def test_gate_by_the_size_of_stored_customers(spark, monkeypatch):
    """Customers that are measured as stored give the plain result; beyond the bound their keys are stored and counted as before."""
    import zonelake.operators.joins as joins
    from zonelake.plans import refine

    readings = spark.createDataFrame([(f"u{k % 7}", k, 1.0, 2.0, 3.0) for k in range(50)], "user string, timestamp long, x double, y double, z double")
    people = spark.createDataFrame([(f"u{k % 4}" if k else None, k) for k in range(9)], "email string, serialnumber long")
    want = rows(refine.accelerometer_trusted(readings, people))
    stored, at_most = refine.stored_customers(people)
    assert at_most == refine.customer_size(people) == (9, 9 * 16 + 8 * 2 + 1)
    for limit in (None, 8, 3, 0):
        if limit is not None:
            monkeypatch.setattr(joins, "BROADCAST_KEYS", limit)
        assert joins.gate_matches(stored, "email", at_most)[1] == (limit in (None, 8))
        assert rows(refine.accelerometer_trusted(readings, stored, at_most=at_most)) == want


def _feature_inputs(spark):
    devices = [(t, s, s % 3, s // 2, s) for s in range(6) for t in range(5)] + [(1, 0, 0, 0, 9), (2, None, None, None, None)]
    accel = [(u, t, float(v), -0.0 if v else 0.0, None) for u in range(3) for t in range(1, 7) for v in range(4)] + [(0, 1, 1.0, 0.0, None)] * 3
    return (
        spark.createDataFrame(devices, "sensorreadingtime long, serialnumber long, distancefromobject int, email long, registrationdate long"),
        spark.createDataFrame(accel, "user long, timestamp long, x double, y double, z double"),
    )


@pytest.mark.parametrize("same_user", [False, True])
@pytest.mark.parametrize("hot_rows", [1, 20, 10**9])
def test_features_are_numbered_without_moving_pairs(spark, monkeypatch, hot_rows, same_user):
    """Against ``number_rows`` on the pairs; no window or sort stands above the join that makes them."""
    devices, accel = _feature_inputs(spark)
    expected = number_rows(fuse_on_time(devices, accel, same_user=same_user), "email", "sensorreadingtime", weight="_w")
    show = lambda df: sorted(map(repr, df.select("email", "sensorreadingtime", "serialnumber", "distancefromobject", "x", "y", "z", "rn").collect()))
    expected = show(expected)
    monkeypatch.setattr(skew, "HOT_ROWS", hot_rows)
    got = joins.ml_features(devices, accel, same_user=same_user)
    assert show(got) == expected
    above = got._jdf.queryExecution().optimizedPlan().toString().partition("Join")[0]
    assert "Window" not in above and "Sort" not in above and "Generate" in above


@pytest.mark.parametrize("hot", [0, 10**9])
def test_sums_before(spark, hot):
    data = [(k, t, w) for k in (None, 1, 2) for t in range(20) for w in (k or 3,)]
    df = spark.createDataFrame(data, "k long, t long, w long").repartition(3)
    frame = None if hot else df.select("k").distinct()
    got = numbering.sums_before(df, "k", "t", "w", name="b", hot=skew.HotKeys(("k",), frame), partitions=5)
    assert rows(got) == sorted(((k, t, w, t * w) for k, t, w in data), key=lambda r: tuple((v is not None, v) for v in r))


def test_copies_in_chunks(spark):
    df = spark.createDataFrame([("a", 0, 5), ("a", 5, 1), ("b", 0, 4)], "k string, lo long, n long")
    expected = [("a", i) for i in range(1, 7)] + [("b", i) for i in range(1, 5)]
    for chunk in (1, 2, 4, 100):
        assert rows(numbering.numbered_copies(df, ["k"], F.col("lo"), F.col("n"), "rn", 5, chunk)) == expected


def test_key_violations_counts_only_suspects(spark):
    """Blocks of neighbouring numbers that hold each key once are sorted out before keys are counted."""
    whole = spark.range(20_000).select((F.col("id") % 7).alias("k"), F.expr("id div 7 - 1000").alias("rn"))
    assert checks._suspects(whole, ["k", "rn"]).count() == 0
    assert checks.key_violations(whole, ["k", "rn"]).first()[1:] == (0, 0)
    bad = spark.createDataFrame([(None, 1), (None, 1), (2, None), (3, -1000), (3, -1000), (4, 5), (99, 1), (99, 1)], "k long, rn long")
    mixed = whole.unionByName(bad)
    assert checks.key_violations(mixed, ["k", "rn"]).first()[1:] == (3, 3)
    assert checks._suspects(mixed, ["k", "rn"]).count() < 1000
    assert checks.key_violations(mixed.select(F.col("k").cast("string"), F.col("rn").cast("string")), ["k", "rn"]).first()[1:] == (3, 3)
    assert checks.key_violations(bad.select("k"), "k").first()[1:] == (2, 2)
