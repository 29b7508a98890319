"""The five jobs on random landing data against the oracle's SQL chain run by
DuckDB on the same rows: null keys and times, repeated readings, shared
instants across users, customers without consent, several records per device."""

from __future__ import annotations

import random

import duckdb
import pandas as pd
import pytest
from conftest import null_first

from zonelake.plans import refine
from zonelake.plans.registry import JOBS_SQL


def _landing(seed: int):
    rnd = random.Random(seed)
    maybe = lambda v, p=0.08: None if rnd.random() < p else v
    customers = []
    for i in range(rnd.randint(10, 40)):
        serial = maybe(rnd.randint(0, 12))
        customers.append(
            {
                "customername": f"c{i % 7}",
                "email": maybe(rnd.randint(0, 6)),
                "phone": None,
                "birthday": "2000-01-01",
                "serialnumber": serial,
                "registrationdate": rnd.randint(0, 5),
                "lastupdatedate": rnd.randint(0, 3),
                "sharewithresearchasofdate": maybe(rnd.randint(0, 9), 0.3),
                "sharewithpublicasofdate": maybe(1, 0.5),
                "sharewithfriendsasofdate": None,
            }
        )
    readings = [
        {"user": maybe(rnd.randint(0, 7)), "timestamp": maybe(rnd.choice([100, 160, 220, 280])),
         "x": float(rnd.randint(0, 2)), "y": 1.0, "z": float(rnd.randint(0, 1))}
        for _ in range(rnd.randint(20, 80))
    ]
    readings += readings[: rnd.randint(0, 5)]  # repeated readings
    steps = [
        {"sensorreadingtime": maybe(rnd.choice([100, 160, 220, 280, 340])), "serialnumber": maybe(rnd.randint(0, 12)),
         "distancefromobject": rnd.randint(0, 3)}
        for _ in range(rnd.randint(10, 50))
    ]
    steps += steps[: rnd.randint(0, 4)]
    return customers, readings, steps


CUSTOMER_DDL = (
    "customername string, email long, phone string, birthday string, serialnumber long, registrationdate long, "
    "lastupdatedate long, sharewithresearchasofdate long, sharewithpublicasofdate long, sharewithfriendsasofdate long"
)
ACCEL_DDL = "user long, timestamp long, x double, y double, z double"
STEP_DDL = "sensorreadingtime long, serialnumber long, distancefromobject int"


def _pandas(records, ddl):
    cols = [c.split()[0] for c in ddl.split(", ")]
    types = {c.split()[0]: c.split()[1] for c in ddl.split(", ")}
    df = pd.DataFrame(records, columns=cols)
    for c in cols:
        if types[c] in ("long", "int"):
            df[c] = pd.array(df[c].tolist(), dtype="Int64" if types[c] == "long" else "Int32")
        elif types[c] == "string":
            df[c] = df[c].astype("string")
    return df


def _rows(records):
    return sorted((tuple(r) for r in records), key=null_first)


@pytest.mark.parametrize("seed,forced_hot", [(1, False), (2, False), (3, False), (4, True), (5, True)])
def test_jobs_on_random_landing_match_sql(spark, monkeypatch, seed, forced_hot):
    if forced_hot:  # every entity and instant over 3 rows takes the skew paths
        import zonelake.operators.joins as joins
        import zonelake.operators.skew as skew

        monkeypatch.setattr(skew, "HOT_ROWS", 3)
        monkeypatch.setattr(joins, "BROADCAST_KEYS", 0)
    customers, readings, steps = _landing(seed)
    c_df = spark.createDataFrame([tuple(r.values()) for r in customers], CUSTOMER_DDL)
    a_df = spark.createDataFrame([tuple(r.values()) for r in readings], ACCEL_DDL)
    s_df = spark.createDataFrame([tuple(r.values()) for r in steps], STEP_DDL)

    ct = refine.customer_trusted(c_df)
    at = refine.accelerometer_trusted(a_df, ct)
    st = refine.step_trainer_trusted(s_df, ct)
    got = {
        "customer_trusted": ct,
        "accelerometer_trusted": at,
        "step_trainer_trusted": st,
        "customer_curated": refine.customer_curated(at, ct),
        "machine_learning_curated": refine.ml_curated(st, at, ct),
        "ml_same_user": refine.ml_curated(st, at, ct, same_user=True),
    }

    con = duckdb.connect()
    con.register("customer_landing", _pandas(customers, CUSTOMER_DDL))
    con.register("accelerometer_landing", _pandas(readings, ACCEL_DDL))
    con.register("step_trainer_landing", _pandas(steps, STEP_DDL))
    for name, df in got.items():
        cur = con.execute(f"WITH {JOBS_SQL} SELECT * FROM {name}")
        want_cols = [d[0] for d in cur.description]
        want = _rows(cur.fetchall())
        assert sorted(df.columns) == sorted(want_cols), name
        have = _rows(tuple(r[c] for c in want_cols) for r in df.collect())
        assert have == want, (seed, name)
