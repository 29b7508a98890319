"""The five jobs through zone tables, and the incremental landing stream."""

from __future__ import annotations

import json
import os

import pytest
from conftest import rows
from fixture_data import write_landing

from zonelake import schemas
from zonelake.plans import refine
from zonelake.plans.jobs import refine_all
from zonelake.sinks.zone import ZoneStore
from zonelake.sources.catalog import Zones
from zonelake.sources.landing import read_landing
from zonelake.streaming.ingest import ingest_landing


def test_refine_all_through_tables(spark, tmp_dir):
    paths = write_landing(os.path.join(tmp_dir, "landing"))
    landing = {
        name: read_landing(spark, paths[name], schemas.LANDING_SCHEMAS[name]) for name in schemas.LANDING_SCHEMAS
    }
    store = ZoneStore(os.path.join(tmp_dir, "lake"), Zones("e2e"))
    expected = {
        "customer_trusted": 3,
        "accelerometer_trusted": 7,
        "step_trainer_trusted": 5,
        "customer_curated": 3,
        "machine_learning_curated": 12,
    }
    report = refine_all(spark, landing, store, expected=expected).collect()
    assert {r["table_name"]: r["row_count"] for r in report} == expected
    assert {r["table_name"]: r["columns"] for r in report}["step_trainer_trusted"] == (
        "struct<sensorreadingtime:bigint,serialnumber:string,distancefromobject:int,rn:bigint>"
    )
    with pytest.raises(AssertionError, match="customer_curated"):
        refine_all(spark, landing, store, expected=expected | {"customer_curated": 4})
    ml = spark.table("e2e_curated.machine_learning_curated")
    assert rows(ml, "email", "rn") == [("a", i) for i in range(1, 13)]
    assert spark.table("e2e_trusted.customer_trusted").where("sharewithresearchasofdate is null").count() == 0


def test_incremental_customer_stream(spark, tmp_dir):
    landing = os.path.join(tmp_dir, "customer")
    os.makedirs(landing)
    store = ZoneStore(os.path.join(tmp_dir, "lake"), Zones("stream"))
    keys, order = refine.TABLE_KEYS["customer_trusted"]

    def drop(name, recs):
        with open(os.path.join(landing, name), "w") as fh:
            fh.write("\n".join(json.dumps(r) for r in recs) + "\n")

    def run():
        q = ingest_landing(
            spark, landing, schemas.CUSTOMER, store, "trusted", "customer_trusted", keys, order,
            os.path.join(tmp_dir, "ckpt"), refine=refine.customer_trusted,
        )
        q.awaitTermination()

    drop("1.json", [
        {"serialNumber": "s1", "email": "a", "registrationDate": 1, "shareWithResearchAsOfDate": 1},
        {"serialNumber": "s2", "email": "b", "registrationDate": 1},
    ])
    run()
    assert rows(store.read(spark, "trusted", "customer_trusted"), "serialnumber", "registrationdate") == [("s1", 1)]
    drop("2.json", [
        {"serialNumber": "s1", "email": "a", "registrationDate": 5, "shareWithResearchAsOfDate": 5},
        {"serialNumber": "s2", "email": "b", "registrationDate": 6, "shareWithResearchAsOfDate": 6},
    ])
    run()
    assert rows(store.read(spark, "trusted", "customer_trusted"), "serialnumber", "registrationdate") == [
        ("s1", 5), ("s2", 6)
    ]
    assert len(store.commits(spark, "trusted", "customer_trusted")) == 2


SF = "/root/testdata/sf0.001"


def test_refine_all_on_test_tables_matches_oracle(spark, tmp_dir):
    import duckdb
    import pytest

    from __spark_entry__ import oracle_sql
    from tools.check_oracle import TABLES, _digest
    from zonelake.sources import mapped

    if not os.path.isdir(SF):
        pytest.skip("test tables not present")
    landing = {name: feed(spark, SF) for name, feed in mapped.FEEDS.items()}
    store = ZoneStore(os.path.join(tmp_dir, "lake"), Zones("mapped"))
    refine_all(spark, landing, store)
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    sql = oracle_sql()
    stored = {
        "customer_trusted": ("trusted", "customer_trusted"),
        "accelerometer_trusted": ("trusted", "accelerometer_trusted"),
        "step_trainer_trusted": ("trusted", "step_trainer_trusted"),
        "customer_curated": ("curated", "customer_curated"),
        "ml_curated": ("curated", "machine_learning_curated"),
    }
    for query, (zone, table) in stored.items():
        df = store.read(spark, zone, table)
        got = [tuple(r) for r in df.collect()]
        cur = con.execute(sql[query])
        want = cur.fetchall()
        assert len(got) == len(want), query
        assert _digest(df.columns, got) == _digest([d[0] for d in cur.description], want), query


def test_cli_runs_jobs_separately(spark, tmp_dir, capsys):
    from zonelake.plans.cli import main

    paths = write_landing(os.path.join(tmp_dir, "landing"))
    root = os.path.join(tmp_dir, "lake")
    common = ["--root", root, "--prefix", "cli"]
    assert main(["customer-trusted", *common, "--customer", paths["customer_landing"]], spark) == 0
    assert main(["accelerometer-trusted", *common, "--accelerometer", paths["accelerometer_landing"]], spark) == 0
    assert main(["step-trainer-trusted", *common, "--step-trainer", paths["step_trainer_landing"]], spark) == 0
    assert main(["curated", *common], spark) == 0
    out = capsys.readouterr().out
    assert "machine_learning_curated\t12" in out and "customer_curated\t3" in out
    assert spark.table("cli_curated.machine_learning_curated").count() == 12
    with pytest.raises(SystemExit):
        main(["customer-trusted", *common], spark)


def test_cli_all_then_customer_upsert(spark, tmp_dir):
    import json

    from zonelake.plans.cli import main

    paths = write_landing(os.path.join(tmp_dir, "landing"))
    root = os.path.join(tmp_dir, "lake")
    common = ["--root", root, "--prefix", "cliall"]
    main(["all", *common, "--customer", paths["customer_landing"], "--accelerometer", paths["accelerometer_landing"],
          "--step-trainer", paths["step_trainer_landing"]], spark)
    store = ZoneStore(root, Zones("cliall"))
    assert rows(store.read(spark, "trusted", "customer_trusted"), "serialnumber") == [("s1",), ("s3",), ("s4",)]
    later = os.path.join(tmp_dir, "later.json")
    with open(later, "w") as fh:
        fh.write(json.dumps({"serialNumber": "s9", "email": "z", "registrationDate": 1, "shareWithResearchAsOfDate": 1}))
    main(["customer-trusted", *common, "--customer", later, "--mode", "upsert"], spark)
    assert rows(store.read(spark, "trusted", "customer_trusted"), "serialnumber") == [
        ("s1",), ("s3",), ("s4",), ("s9",)
    ]


def test_stream_replay_leaves_table_unchanged(spark, tmp_dir):
    landing = os.path.join(tmp_dir, "customer")
    os.makedirs(landing)
    with open(os.path.join(landing, "1.json"), "w") as fh:
        fh.write(json.dumps({"serialNumber": "s1", "email": "a", "registrationDate": 3, "shareWithResearchAsOfDate": 3}))
    store = ZoneStore(os.path.join(tmp_dir, "lake"), Zones("replay"))
    keys, order = refine.TABLE_KEYS["customer_trusted"]
    for attempt in range(2):  # a fresh checkpoint is another stream of the same files
        ingest_landing(
            spark, landing, schemas.CUSTOMER, store, "trusted", "customer_trusted", keys, order,
            os.path.join(tmp_dir, f"ckpt{attempt}"), refine=refine.customer_trusted,
        ).awaitTermination()
    assert len(store.commits(spark, "trusted", "customer_trusted")) == 2
    assert rows(store.read(spark, "trusted", "customer_trusted"), "serialnumber", "registrationdate") == [("s1", 3)]


def test_independent_jobs_run_at_once(spark):
    """Both have started before either ends; local properties are the caller's and a failure is raised."""
    import threading

    from zonelake.session import at_once

    both = threading.Barrier(2, timeout=60)
    spark.sparkContext.setLocalProperty("zonelake.test", "yes")

    def job(n):
        both.wait()
        return spark.range(n).count(), spark.sparkContext.getLocalProperty("zonelake.test")

    assert at_once(spark, lambda: job(5), lambda: job(7)) == [(5, "yes"), (7, "yes")]
    with pytest.raises(ZeroDivisionError):
        at_once(spark, lambda: spark.range(3).count(), lambda: 1 // 0)
