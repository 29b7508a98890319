"""FIXTURES.md §2: each trap of the original jobs on hand-written rows."""

from __future__ import annotations

import pytest
from conftest import rows
from fixture_data import write_landing
from pyspark.sql import functions as F

from zonelake import schemas
from zonelake.operators.joins import customers_with_readings
from zonelake.plans import refine
from zonelake.sources.landing import read_landing


@pytest.fixture(scope="module")
def landing(spark, tmp_path_factory):
    paths = write_landing(str(tmp_path_factory.mktemp("landing")))
    return {
        "customer_landing": read_landing(spark, paths["customer_landing"], schemas.CUSTOMER),
        "accelerometer_landing": read_landing(spark, paths["accelerometer_landing"], schemas.ACCELEROMETER),
        "step_trainer_landing": read_landing(spark, paths["step_trainer_landing"], schemas.STEP_TRAINER),
    }


@pytest.fixture(scope="module")
def trusted(landing):
    customers = refine.customer_trusted(landing["customer_landing"])
    accel = refine.accelerometer_trusted(landing["accelerometer_landing"], customers)
    steps = refine.step_trainer_trusted(landing["step_trainer_landing"], customers)
    return customers, accel, steps


def test_customer_trusted_consent_and_keep_latest(trusted):
    customers, _, _ = trusted
    assert rows(customers, "serialnumber", "registrationdate") == [("s1", 20), ("s3", 20), ("s4", 10)]
    assert customers.columns == schemas.CUSTOMER_COLUMNS


def test_accelerometer_trusted_email_fan_out(trusted):
    _, accel, _ = trusted
    got = rows(accel, "user", "rn")
    assert got == [("a", i) for i in range(1, 7)] + [("c", 1)]
    assert accel.columns == ["user", "timestamp", "x", "y", "z", "rn"]
    # whole numbers in the files are read as doubles through the schema
    assert dict(accel.dtypes)["x"] == "double"
    # numbering follows time: a's two readings at 100 (x2 devices) come first
    assert rows(accel.where("user = 'a' and timestamp = 101"), "rn") == [(5,), (6,)]


def test_step_trainer_trusted_keeps_repeated_reading(trusted):
    _, _, steps = trusted
    assert rows(steps, "serialnumber", "rn") == [("s1", i) for i in range(1, 5)] + [("s3", 1)]
    assert rows(steps.where("serialnumber = 's1'"), "sensorreadingtime", "rn") == [
        (100, 1), (100, 2), (101, 3), (999, 4)
    ]


def test_customer_join_fan_out_is_13(trusted):
    customers, accel, _ = trusted
    assert accel.join(customers, F.col("user") == F.col("email")).count() == 13


def test_customer_curated_equals_semi_join(trusted):
    customers, accel, _ = trusted
    curated = refine.customer_curated(accel, customers)
    semi = customers_with_readings(customers, accel)
    assert rows(curated) == rows(semi.select(*curated.columns))
    assert rows(curated, "serialnumber") == [("s1",), ("s3",), ("s4",)]


def test_device_readings_remove_repeats(trusted):
    customers, accel, steps = trusted
    dev = refine.device_readings(steps, accel, customers)
    assert rows(dev, "sensorreadingtime", "serialnumber", "distancefromobject", "email") == [
        (100, "s1", 5, "a"), (100, "s3", 8, "a"), (101, "s1", 6, "a"), (999, "s1", 9, "a")
    ]


def test_ml_curated_time_only_join(trusted):
    customers, accel, steps = trusted
    ml = refine.ml_curated(steps, accel, customers)
    assert ml.columns == schemas.ML_COLUMNS + ["rn"]
    assert rows(ml, "email", "rn") == [("a", i) for i in range(1, 13)]
    same = refine.ml_curated(steps, accel, customers, same_user=True)
    assert same.count() == 10


def test_ml_curated_from_gated_frames_matches(landing, trusted):
    customers, accel, steps = trusted
    gated_a = refine.gated_accelerometer(landing["accelerometer_landing"], customers)
    gated_s = refine.gated_step_trainer(landing["step_trainer_landing"], customers)
    direct = refine.ml_curated(steps, accel, customers)
    via_gate = refine.ml_curated(gated_s, gated_a, customers, accel_weight=refine.DEVICES)
    assert rows(direct) == rows(via_gate)


def test_malformed_line_never_reaches_trusted(spark, tmp_dir):
    paths = write_landing(tmp_dir)
    raw = read_landing(spark, paths["accelerometer_landing"], schemas.ACCELEROMETER, keep_corrupt=True)
    raw = raw.cache()
    assert raw.where(F.col("_corrupt_record").isNotNull()).count() == 1
    assert raw.count() == 7


def test_schema_report(trusted):
    from zonelake.plans.checks import schema_report

    customers, accel, _ = trusted
    report = schema_report({"customer_trusted": customers, "accelerometer_trusted": accel})
    got = rows(report.where("table_name = 'accelerometer_trusted'"), "position", "column_name", "data_type")
    assert got == [(1, "user", "string"), (2, "timestamp", "bigint"), (3, "x", "double"), (4, "y", "double"),
                   (5, "z", "double"), (6, "rn", "bigint")]
