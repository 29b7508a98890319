"""Landing reads, schema inference, catalog registration and statistics."""

from __future__ import annotations

import json
import os

import pytest
from conftest import rows
from fixture_data import write_landing
from pyspark.sql import functions as F

from zonelake import schemas
from zonelake.operators.projection import lower_columns
from zonelake.sources.catalog import Zones, read_zone
from zonelake.sources.landing import infer_landing_schema, landing_stats, read_landing, register_landing


def test_missing_path_raises_runtime_error(spark, tmp_dir):
    with pytest.raises(RuntimeError, match="nope"):
        read_landing(spark, os.path.join(tmp_dir, "nope"))


def test_schema_gives_doubles_inference_gives_longs(spark, tmp_dir):
    paths = write_landing(tmp_dir)
    inferred = infer_landing_schema(spark, paths["accelerometer_landing"])
    types = {f.name: f.dataType.simpleString() for f in inferred.fields}
    assert types["x"] == "bigint"
    typed = read_landing(spark, paths["accelerometer_landing"], schemas.ACCELEROMETER)
    assert dict(typed.dtypes)["x"] == "double"


def test_camel_case_keys_resolve_case_insensitively(spark, tmp_dir):
    paths = write_landing(tmp_dir)
    steps = read_landing(spark, paths["step_trainer_landing"], schemas.STEP_TRAINER)
    picked = steps.where("serialnumber = 's3'").select("sensorreadingtime", "distancefromobject")
    assert lower_columns(picked).collect() == [(100, 8)]


def test_any_case_of_keys_gives_equal_rows(spark, tmp_dir):
    records = [{"sensorReadingTime": 1, "serialNumber": "s", "distanceFromObject": 2}, {"sensorReadingTime": 2, "serialNumber": "7", "distanceFromObject": None}]
    got = []
    for name, change in (("camel", str), ("lower", str.lower), ("upper", str.upper)):
        os.makedirs(os.path.join(tmp_dir, name))
        with open(os.path.join(tmp_dir, name, "a.json"), "w") as fh:
            fh.write("\n".join(json.dumps({change(k): v for k, v in r.items()}) for r in records) + "\n\nnot json\n")
        frame = read_landing(spark, os.path.join(tmp_dir, name), schemas.STEP_TRAINER, keep_corrupt=True, required=["serialNumber"])
        assert frame.columns == [*schemas.STEP_TRAINER.fieldNames(), "_corrupt_record"]
        got.append(rows(frame))
    assert got[0] == got[1] == got[2] == [(None, None, None, "not json"), (1, "s", 2, None), (2, "7", None, None)]
    with pytest.raises(RuntimeError, match="no record has the key email"):
        read_landing(spark, os.path.join(tmp_dir, "camel"), schemas.STEP_TRAINER, required=["email"])
    table = register_landing(spark, "cases_landing", "upper", lower_columns(frame.drop("_corrupt_record")).schema, os.path.join(tmp_dir, "upper"))
    assert rows(table.where("serialnumber is not null")) == [(1, "s", 2), (2, "7", None)]


def test_values_that_do_not_fit_are_null(spark, tmp_dir):
    path = os.path.join(tmp_dir, "odd.json")
    with open(path, "w") as fh:
        fh.write('{"user": "a", "timestamp": "soon", "x": "1e3", "y": true, "z": 5}\n{"user": 7, "timestamp": 12}\n[1]\n3\n{}\n')
    got = rows(read_landing(spark, path, schemas.ACCELEROMETER))
    assert ("a", None, 1000.0, None, 5.0) in got and ("7", 12, None, None, None) in got
    assert landing_stats(spark, path, schemas.ACCELEROMETER).first()["malformed"] == 3


def test_keys_differing_in_case_fail_at_read(spark, tmp_dir):
    path = os.path.join(tmp_dir, "clash")
    os.makedirs(path)
    with open(os.path.join(path, "a.json"), "w") as fh:
        fh.write(json.dumps({"User": "a", "user": "b"}) + "\n")
    with pytest.raises(RuntimeError):
        read_landing(spark, path)
    with pytest.raises(Exception, match="(?i)duplicate"):
        read_landing(spark, path, schemas.ACCELEROMETER).collect()


def test_register_landing_and_read_zone(spark, tmp_dir):
    paths = write_landing(tmp_dir)
    zones = Zones("fixture")
    table = register_landing(
        spark, zones.database("landing"), "step_trainer_landing", schemas.STEP_TRAINER, paths["step_trainer_landing"]
    )
    assert table.count() == 6
    assert read_zone(spark, "landing", "step_trainer_landing", zones).count() == 6
    with pytest.raises(RuntimeError, match="fixture_landing.missing"):
        read_zone(spark, "landing", "missing", zones)


def test_landing_stats(spark, tmp_dir):
    paths = write_landing(tmp_dir)
    stats = landing_stats(spark, paths["accelerometer_landing"], schemas.ACCELEROMETER).first()
    size = os.path.getsize(os.path.join(paths["accelerometer_landing"], "part-0.json"))
    assert stats["records"] == 7
    assert stats["objects"] == 1
    assert stats["size_bytes"] == size
    assert stats["malformed"] == 1
    assert stats["mean_record_bytes"] == pytest.approx(size / 7)


def test_landing_stats_over_several_files_and_single_file_table(spark, tmp_dir):
    paths = write_landing(tmp_dir)
    folder = paths["step_trainer_landing"]
    with open(os.path.join(folder, "part-1.json"), "w") as fh:
        fh.write(json.dumps({"sensorReadingTime": 1, "serialNumber": "s9", "distanceFromObject": 2}) + "\n")
    stats = landing_stats(spark, folder, schemas.STEP_TRAINER).first()
    assert (stats["records"], stats["objects"], stats["malformed"]) == (7, 2, 0)
    sizes = sum(os.path.getsize(os.path.join(folder, f)) for f in os.listdir(folder) if f.endswith(".json"))
    assert stats["size_bytes"] == sizes
    table = register_landing(spark, "single_landing", "customer_landing", schemas.CUSTOMER, paths["customer_landing"])
    assert table.count() == 5
    assert table.where("shareWithResearchAsOfDate is null").count() == 1


def _scan(df):
    """The physical plan as text."""
    return df._jdf.queryExecution().executedPlan().toString()


def test_the_json_source_parses_once_and_takes_the_consent_filter(spark, tmp_dir):
    from zonelake.operators.filters import consent_filter

    paths = write_landing(tmp_dir)
    read = lower_columns(read_landing(spark, paths["customer_landing"], schemas.CUSTOMER, required=schemas.REQUIRED_KEYS["customer_landing"]))
    plan = _scan(consent_filter(read).select("email"))
    assert "FileScan json" in plan and "PushedFilters: [IsNotNull(shareWithResearchAsOfDate)]" in plan
    assert "ReadSchema: struct<email:string,shareWithResearchAsOfDate:string>" in plan and "from_json" not in plan
    table = register_landing(spark, "scan_landing", "customer", schemas.CUSTOMER, paths["customer_landing"])
    assert "PushedFilters: [IsNotNull(shareWithResearchAsOfDate)]" in _scan(table.where("shareWithResearchAsOfDate IS NOT NULL"))
    assert rows(consent_filter(read)) == rows(consent_filter(lower_columns(read_landing(spark, paths["customer_landing"], schemas.CUSTOMER, exact_keys=True))))


def test_files_of_different_spellings_and_a_late_change(spark, tmp_dir):
    """Several spellings: every line's keys are compared; one that changes after the first records needs ``exact_keys``."""
    folder = os.path.join(tmp_dir, "mixed")
    os.makedirs(folder)
    for name, keys in (("a", ("user", "timestamp")), ("b", ("USER", "TimeStamp"))):
        with open(os.path.join(folder, f"{name}.json"), "w") as fh:
            fh.write("\n".join(json.dumps({keys[0]: name, keys[1]: i}) for i in range(3)) + "\n{broken\n")
    got = read_landing(spark, folder, schemas.ACCELEROMETER, required=["user"], keep_corrupt=True)
    assert rows(got, "user", "timestamp", "_corrupt_record") == [(None, None, "{broken")] * 2 + [(n, i, None) for n in "ab" for i in range(3)]
    table = register_landing(spark, "mixed_landing", "accelerometer", schemas.ACCELEROMETER, folder)
    assert table.where("user = 'b'").count() == 3
    late = os.path.join(tmp_dir, "late.json")
    with open(late, "w") as fh:
        fh.write("\n".join(json.dumps({"user" if i < 1500 else "User": "u", "timestamp": i}) for i in range(1600)))
    assert read_landing(spark, late, schemas.ACCELEROMETER, exact_keys=True).where("user IS NULL").count() == 0


def test_both_ways_of_reading_agree(spark, tmp_dir):
    """Values that do not fit, escapes, nested values and malformed lines: the JSON source and the map give equal rows."""
    path = os.path.join(tmp_dir, "odd.json")
    lines = ['{"user": "a\\u00e9\\n\\"b", "timestamp": "soon", "x": "1e3", "y": true, "z": 5}', '{"user": {"k":[1,2]}, "timestamp": 12.0, "x": 0.10}', "  ", "[1]", "3", "{}",
             '{"user": null, "timestamp": 9223372036854775808, "x": -0.0}', '{"user": "cut', '{"user": 1.5, "z": 1E2}']
    with open(path, "w") as fh:
        fh.write("\n".join(lines))
    one = read_landing(spark, path, schemas.ACCELEROMETER)
    other = read_landing(spark, path, schemas.ACCELEROMETER, exact_keys=True)
    assert "FileScan json" in _scan(one) and "FileScan text" in _scan(other)
    assert rows(one.where("user IS NOT NULL")) == rows(other.where("user IS NOT NULL"))
    assert rows(one) == rows(other)


def test_statistics_of_a_catalog_table(spark, tmp_dir):
    """The planner sees sizes, and with the cost-based optimizer rows; files are counted from their metadata."""
    from zonelake.sinks.zone import ZoneStore
    from zonelake.sources.catalog import analyze_table, file_statistics

    store = ZoneStore(tmp_dir, Zones("stats"))
    store.write(spark.range(0, 1000, 1, 4).selectExpr("id AS k", "id AS o"), "trusted", "t", "k", "o")
    name = "stats_trusted.t__rows"
    files = [os.path.join(d, f) for d, _, fs in os.walk(os.path.join(tmp_dir, "trusted", "t", "rows")) for f in fs if f.endswith(".parquet")]
    size = sum(os.path.getsize(f) for f in files)
    got = file_statistics(spark.table(name), "t").first()
    assert (got["records"], got["objects"], got["size_bytes"]) == (1000, len(files), size)
    assert got["mean_record_bytes"] == pytest.approx(size / 1000)
    assert "ReadSchema: struct<>" in _scan(file_statistics(spark.table(name)))
    assert analyze_table(spark, name)[1] == 1000 and store.analyze(spark, "trusted", "t")[0] >= size
    cost = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("cost")
    spark.conf.set("spark.sql.cbo.enabled", "true")
    try:
        assert "rowCount=1.00E+3" in spark.table("stats_trusted.t")._jdf.queryExecution().explainString(cost)
    finally:
        spark.conf.unset("spark.sql.cbo.enabled")
    assert file_statistics(spark.table(name).where("_commit > 5")).first()["records"] == 0


def test_landing_files_of_the_queries_are_small(spark, tmp_dir, monkeypatch):
    """The JSON files that the queries read are compressed, of a bounded number of records each, and hold the feeds' rows."""
    from zonelake.plans import registry
    from zonelake.sources import mapped

    made = spark.range(3000).withColumn("day", F.expr("TIMESTAMP_NTZ'1995-01-01' + make_interval(0, 0, 0, cast(id % 2000 as int))"))
    orders = made.selectExpr("id AS o_orderkey", "id % 500 AS o_custkey", "if(id % 3 = 0, 'F', 'O') AS o_orderstatus", "day AS o_orderdate", "'2-HIGH' AS o_orderpriority")
    events = made.selectExpr("day AS ts", "id % 90 AS user_id", "element_at(array('click', 'error', null), cast(id % 3 + 1 as int)) AS event_type", "id / 7D AS value", "concat('{\"k\": ', id % 40, '}') AS props")
    orders.coalesce(1).write.parquet(f"{tmp_dir}/orders.parquet")
    events.coalesce(1).write.parquet(f"{tmp_dir}/events.parquet")
    monkeypatch.setattr(registry, "LANDING_RECORDS", 400, raising=False)
    folder = registry._json_files(spark, tmp_dir)
    for name, feed in mapped.FEEDS.items():
        feed, lines = feed(spark, tmp_dir), spark.read.text(f"{folder}/{name}").select("value", F.input_file_name().alias("file"))
        per_file = [r["count"] for r in lines.groupBy("file").count().collect()]
        assert max(per_file) <= 400 and sum(per_file) == feed.count() > 400
        packed = sum(os.path.getsize(f"{folder.removeprefix('file:')}/{name}/{f}") for f in os.listdir(f"{folder.removeprefix('file:')}/{name}"))
        assert packed < lines.agg(F.sum(F.length("value"))).first()[0] / 2
        read = read_landing(spark, f"{folder}/{name}", feed.schema, required=schemas.REQUIRED_KEYS[name])
        assert rows(read) == rows(feed)
