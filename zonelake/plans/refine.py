"""The refinement jobs as functions from DataFrames to DataFrames.

landing -> trusted:
  customer_trusted       consenting customers, latest record per device
  accelerometer_trusted  readings of consenting users, numbered per user
  step_trainer_trusted   readings of consenting devices, numbered per device
trusted -> curated:
  customer_curated       consenting customers that have accelerometer readings
  ml_curated             device readings paired with accelerometer readings of
                         the same time, numbered per email

Inputs may carry the landing key names in any case; outputs are lower case.
Reading and writing stay outside (``sources``, ``sinks``), so each job can be
run on any frames, and ``refine`` chains them through the zone tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonelake.operators.dedup import keep_latest
from zonelake.operators.filters import consent_filter
from zonelake.operators.joins import (
    customers_with_readings,
    device_readings_with_owner,
    gate,
    gate_matches,
    key_bytes,
    ml_features,
)
from zonelake.operators.numbering import number_rows
from zonelake.operators.projection import keep_columns, lower_columns
from zonelake.operators.skew import no_hot_keys
from zonelake.schemas import ACCELEROMETER_COLUMNS, CUSTOMER_COLUMNS, STEP_TRAINER_COLUMNS
from zonelake.session import materialize, materialize_counted

# Count columns of the gated (not yet numbered) sensor frames.
DEVICES = "_devices"
OWNERS = "_owners"

# Record keys and ordering fields of the refined tables.
TABLE_KEYS = {
    "customer_trusted": (["serialnumber"], "registrationdate"),
    "accelerometer_trusted": (["user", "rn"], "timestamp"),
    "step_trainer_trusted": (["serialnumber", "rn"], "sensorreadingtime"),
    "customer_curated": (["serialnumber"], "registrationdate"),
    "machine_learning_curated": (["email", "rn"], "sensorreadingtime"),
}


def customer_trusted(customers: DataFrame) -> DataFrame:
    """Customers that consented to research use, latest record per device."""
    keys, order = TABLE_KEYS["customer_trusted"]
    return keep_latest(consent_filter(lower_columns(customers)), keys, order)


def gated_accelerometer(readings: DataFrame, customers: DataFrame, *, at_most: tuple[int, int] | None = None) -> DataFrame:
    """Accelerometer readings of consenting users, before numbering: each
    reading once, with the number of trusted devices of its user in
    ``_devices`` (the original email join repeated it that many times)."""
    readings = keep_columns(lower_columns(readings), ACCELEROMETER_COLUMNS)
    customers = lower_columns(customers)
    return gate(readings, customers, "user", "email", weight=DEVICES, matches=gate_matches(customers, "email", at_most))


def stored_customers(customers: DataFrame) -> tuple[DataFrame, tuple[int, int]]:
    """The trusted customers written once, and their measured ``at_most`` for the sensor jobs."""
    table, rows, size = materialize_counted(lower_columns(customers), key_bytes("email", "serialnumber"))
    return table, (rows, size)


def customer_size(customers: DataFrame) -> tuple[int, int]:
    """``at_most`` of customers that are stored already (a scan of two columns)."""
    got = lower_columns(customers).agg(F.count(F.lit(1)), F.coalesce(F.sum(key_bytes("email", "serialnumber")), F.lit(0))).first()
    return int(got[0]), int(got[1])


def _numbered(
    readings: DataFrame, customers: DataFrame, row_key: str, gate_key: str, order: str, weight: str, at_most: tuple[int, int] | None
) -> DataFrame:
    """Gated readings with their copies, numbered.  The landing rows are parsed once: the gated frame is stored, its copies are
    added up while it is written, and hot keys are counted on what is stored where one task could not take all copies."""
    matches = gate_matches(customers, gate_key, at_most)
    if not matches[1]:  # the gate then counts keys before it joins
        readings = materialize(readings)
    gated, _, copies = materialize_counted(gate(readings, customers, row_key, gate_key, weight=weight, matches=matches), F.col(weight))
    return number_rows(gated, row_key, order, weight=weight, hot=no_hot_keys([row_key], copies, readings.sparkSession))


def accelerometer_trusted(readings: DataFrame, customers: DataFrame, *, at_most: tuple[int, int] | None = None) -> DataFrame:
    """Accelerometer readings of consenting users, numbered per user in time order.

    A reading is kept once per trusted device of its user (the email join of
    the original job); the copies travel as a count until the numbering.  ``at_most``: the (rows, bytes of keys) of stored
    customers (``stored_customers``, ``customer_size``), which spares storing their keys.
    """
    readings = keep_columns(lower_columns(readings), ACCELEROMETER_COLUMNS)
    return _numbered(readings, lower_columns(customers), "user", "email", "timestamp", DEVICES, at_most)


def gated_step_trainer(readings: DataFrame, customers: DataFrame, *, at_most: tuple[int, int] | None = None) -> DataFrame:
    """Step-trainer readings of consenting devices, before numbering, with
    the number of trusted customer rows of the device in ``_owners``."""
    readings = keep_columns(lower_columns(readings), STEP_TRAINER_COLUMNS)
    customers = lower_columns(customers)
    return gate(readings, customers, "serialnumber", "serialnumber", weight=OWNERS, matches=gate_matches(customers, "serialnumber", at_most))


def step_trainer_trusted(readings: DataFrame, customers: DataFrame, *, at_most: tuple[int, int] | None = None) -> DataFrame:
    """Step-trainer readings of consenting devices, numbered per device in time order.  ``at_most``: see ``accelerometer_trusted``."""
    readings = keep_columns(lower_columns(readings), STEP_TRAINER_COLUMNS)
    return _numbered(readings, lower_columns(customers), "serialnumber", "serialnumber", "sensorreadingtime", OWNERS, at_most)


def curated_owners(accel_trusted: DataFrame, customers: DataFrame) -> DataFrame:
    """Trusted customers whose email has accelerometer readings (the ten
    customer columns, one row per customer row)."""
    owners = customers_with_readings(lower_columns(customers), accel_trusted, "email", "user")
    return keep_columns(owners, CUSTOMER_COLUMNS)


def customer_curated(accel_trusted: DataFrame, customers: DataFrame) -> DataFrame:
    """Curated customers: trusted customers with readings, latest per device."""
    keys, order = TABLE_KEYS["customer_curated"]
    return keep_latest(curated_owners(accel_trusted, customers), keys, order)


def device_readings(
    step_trusted: DataFrame, accel_trusted: DataFrame, customers: DataFrame, owners: DataFrame | None = None
) -> DataFrame:
    """Distinct device readings with the owner's email and registration date.  ``owners``: the stored curated
    customers, which are the owners where customers are unique per device (they are once they are trusted)."""
    owners = curated_owners(accel_trusted, customers) if owners is None else lower_columns(owners)
    return device_readings_with_owner(step_trusted, owners)


def ml_curated(
    step_trusted: DataFrame,
    accel_trusted: DataFrame,
    customers: DataFrame,
    *,
    owners: DataFrame | None = None,
    same_user: bool = False,
    accel_weight: str | None = None,
    persist: bool = False,
) -> DataFrame:
    """Machine-learning table: every device reading paired with every
    accelerometer reading of the same time, numbered per email.

    As in the original job the pairing is on time only, so a reading of
    another user at that instant is paired too; ``same_user=True`` requires
    the accelerometer user to be the device owner's email.

    Only the reading columns of the trusted tables are used (``rn`` is not),
    so the gated frames can stand in for them: ``accel_weight`` then names
    the column counting the copies of each accelerometer reading.  ``owners``: see ``device_readings``;
    ``persist``: keep the fusion's inputs in executors rather than in the checkpoint folder.
    """
    devices = device_readings(step_trusted, accel_trusted, customers, owners)
    return ml_features(devices, accel_trusted, same_user=same_user, accel_weight=accel_weight, persist=persist)
