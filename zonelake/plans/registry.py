"""Registered queries over the shared test tables, each with an independent
SQL formulation for the oracle.

The landing feeds come from ``orders`` and ``events`` (``sources.mapped``).
The SQL side is written the way the original jobs were: an inner join whose
fan-out is collapsed by a keep-latest or a DISTINCT, and ``row_number``
windows.  The Spark side uses the semi-join, weighted numbering and
aggregate forms, so agreement checks those rewrites too.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from zonelake.operators.dedup import distinct_rows, keep_latest
from zonelake.operators.filters import consent_filter
from zonelake.operators.projection import lower_columns
from zonelake.plans import checks, refine
from zonelake.plans.jobs import refine_all, report
from zonelake.schemas import REQUIRED_KEYS
from zonelake.session import at_once, checkpoint_dir, configure, materialize
from zonelake.sinks.partitions import replace_partitions
from zonelake.sinks.zone import ZoneStore
from zonelake.sources import mapped
from zonelake.sources.catalog import Zones, analyze_table, file_statistics, read_zone
from zonelake.sources.landing import infer_landing_schema, landing_stats, read_landing, register_landing

Query = Callable[[SparkSession, str], DataFrame]


# --------------------------------------------------------------------- Spark


def landing(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    configure(spark)
    return lower_columns(mapped.FEEDS[name](spark, sf_dir))


def _customer_trusted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return refine.customer_trusted(mapped.customer_feed(configure(spark), sf_dir))


Size = tuple[int, int]


def _stored_customers(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, Size]:
    """Trusted customers written once and measured, as the refinement stores them before
    the sensor jobs read them (each composite query uses them several times)."""
    return refine.stored_customers(_customer_trusted(spark, sf_dir))


def _accel_trusted(spark: SparkSession, sf_dir: str, customers: DataFrame | None = None, at_most: Size | None = None) -> DataFrame:
    customers = customers if customers is not None else _customer_trusted(spark, sf_dir)
    return refine.accelerometer_trusted(mapped.accelerometer_feed(spark, sf_dir), customers, at_most=at_most)


def _step_trusted(spark: SparkSession, sf_dir: str, customers: DataFrame | None = None, at_most: Size | None = None) -> DataFrame:
    customers = customers if customers is not None else _customer_trusted(spark, sf_dir)
    return refine.step_trainer_trusted(mapped.step_trainer_feed(spark, sf_dir), customers, at_most=at_most)


def _trusted(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The three trusted tables."""
    stored = _stored_customers(configure(spark), sf_dir)
    sensors = at_once(spark, lambda: _accel_trusted(spark, sf_dir, *stored), lambda: _step_trusted(spark, sf_dir, *stored))
    return stored[0], *sensors


def q_consent_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return consent_filter(landing(spark, sf_dir, "customer_landing"))


def q_customer_reading_fanout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings per trusted device before the curated dedup (the fan-out of
    the customer join), counted without building the fan-out: a device of
    email e meets every trusted reading of e."""
    stored = _stored_customers(configure(spark), sf_dir)
    customers, accel = stored[0], _accel_trusted(spark, sf_dir, *stored)
    per_user = accel.groupBy("user").agg(F.count(F.lit(1)).alias("_r"))
    joined = customers.join(per_user, F.col("email") == F.col("user"), "inner")
    return joined.groupBy("serialnumber").agg(F.sum("_r").alias("readings"))


def q_customer_curated(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored = _stored_customers(configure(spark), sf_dir)
    return refine.customer_curated(_accel_trusted(spark, sf_dir, *stored), stored[0])


def q_device_readings_with_owner(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers, accel, steps = _trusted(spark, sf_dir)
    return refine.device_readings(steps, accel, customers)


def q_device_readings_raw_lineage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The original job's form of the device readings: the step readings
    joined to the customer join before its dedup (one customer row per
    accelerometer reading), collapsed by a whole-row distinct (DST-1).  Kept
    to exercise the distinct on a real fan-out; ``device_readings_with_owner``
    is the form to use."""
    customers, accel, steps = _trusted(spark, sf_dir)
    fan_out = accel.join(customers, F.col("user") == F.col("email"), "inner").select("serialnumber", "email",
                                                                                    "registrationdate")
    joined = steps.join(fan_out, "serialnumber", "inner").select(
        "sensorreadingtime", "serialnumber", "distancefromobject", "email", "registrationdate"
    )
    return distinct_rows(joined)


def q_ml_curated(spark: SparkSession, sf_dir: str, same_user: bool = False) -> DataFrame:
    """From the trusted tables, as the original job."""
    customers, accel, steps = _trusted(spark, sf_dir)
    return refine.ml_curated(steps, accel, customers, same_user=same_user)


def q_ml_curated_from_landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same table without the trusted sensor tables.

    The curated jobs never read ``rn`` and meet the sensor tables only through joins with the trusted customers, so the
    gated readings with their copy count stand for accelerometer_trusted, and the raw step readings for
    step_trainer_trusted.
    """
    customers, at_most = _stored_customers(configure(spark), sf_dir)
    accel = refine.gated_accelerometer(landing(spark, sf_dir, "accelerometer_landing"), customers, at_most=at_most)
    steps = landing(spark, sf_dir, "step_trainer_landing")
    return refine.ml_curated(steps, accel, customers, same_user=False, accel_weight=refine.DEVICES)


def _refined(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    customers, accel, steps = _trusted(spark, sf_dir)
    accel, steps = materialize(accel), materialize(steps)  # each has several readers here
    curated = materialize(refine.customer_curated(accel, customers))
    return {
        "customer_trusted": customers,
        "accelerometer_trusted": accel,
        "step_trainer_trusted": steps,
        "customer_curated": curated,
        "machine_learning_curated": refine.ml_curated(steps, accel, customers, owners=curated),
    }


# ------------------------------------------------- JSON files, catalog and stored tables

_made: dict[tuple, object] = {}  # what this application has written, by (application, table folder, what)


def _once(spark: SparkSession, sf_dir: str, what: str, make: Callable[[str], object]) -> object:
    """``make(folder)`` in a new folder beside the checkpoints, once per application and input."""
    key = (spark.sparkContext.applicationId, sf_dir, what)
    if key not in _made:
        _made[key] = make(f"{checkpoint_dir(configure(spark))}/{what}-{uuid.uuid4().hex[:12]}")
    return _made[key]


#: records of a landing file: gzip files are not split, so this is what a task reads at least
LANDING_RECORDS = 500_000


def _json_files(spark: SparkSession, sf_dir: str) -> str:
    """The mapped feeds as JSON-lines files (gzip), a folder each."""

    def make(folder: str) -> str:
        for name, feed in mapped.FEEDS.items():
            feed(spark, sf_dir).write.options(compression="gzip", maxRecordsPerFile=LANDING_RECORDS).json(f"{folder}/{name}")
        return folder

    return _once(spark, sf_dir, "landing", make)


def _lake(spark: SparkSession, sf_dir: str) -> ZoneStore:
    """All five jobs from the JSON files into zone tables."""

    def make(folder: str) -> ZoneStore:
        files = _json_files(spark, sf_dir)
        read = {
            name: read_landing(spark, f"{files}/{name}", feed(spark, sf_dir).schema, required=REQUIRED_KEYS[name])
            for name, feed in mapped.FEEDS.items()
        }
        store = ZoneStore(folder, Zones("q" + folder.rsplit("-", 1)[1]))
        refine_all(spark, read, store)
        return store

    return _once(spark, sf_dir, "lake", make)


def _stored(zone: str, table: str) -> Query:
    """A table that the jobs have stored, read through the catalog."""
    return lambda spark, sf_dir: read_zone(spark, zone, table, _lake(spark, sf_dir).zones)


def _cataloged(name: str) -> Query:
    """A landing feed through its catalog table, whose columns are declared in lower case."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        files = _json_files(spark, sf_dir)
        schema = lower_columns(mapped.FEEDS[name](spark, sf_dir)).schema
        return register_landing(spark, "q" + files.rsplit("-", 1)[1], name, schema, f"{files}/{name}")

    return query


def q_single_file_landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The customer feed as one JSON file, read by the file's own path (as the original customer job did)."""

    def make(folder: str) -> str:
        mapped.customer_feed(spark, sf_dir).coalesce(1).write.json(folder)
        return spark.read.text(folder).inputFiles()[0]

    path = _once(spark, sf_dir, "single", make)
    return lower_columns(read_landing(spark, path, mapped.customer_feed(spark, sf_dir).schema, required=REQUIRED_KEYS["customer_landing"]))


def q_landing_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = _json_files(spark, sf_dir)
    stats = [
        landing_stats(spark, f"{files}/{name}", feed(spark, sf_dir).schema).select(F.lit(name).alias("table_name"), "records", "malformed")
        for name, feed in mapped.FEEDS.items()
    ]
    return checks.union_all(stats)


def q_landing_schemas(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = _json_files(spark, sf_dir)
    frames = {n: lower_columns(spark.createDataFrame([], infer_landing_schema(spark, f"{files}/{n}"))) for n in mapped.FEEDS}
    return checks.schema_report(frames).select("table_name", "column_name", "data_type")


def q_zone_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.zone_counts(_refined(spark, sf_dir))


def q_landing_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.zone_counts({name: landing(spark, sf_dir, name) for name in mapped.FEEDS})


def q_consent_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.consent_violations(_customer_trusted(spark, sf_dir))


def q_key_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = _refined(spark, sf_dir)
    frames = [checks.key_violations(df, refine.TABLE_KEYS[name][0], name) for name, df in tables.items()]
    return checks.union_all(frames)


def q_preview_customer_trusted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.preview(_customer_trusted(spark, sf_dir), "serialnumber", 5)


def q_preview_ml_curated(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.preview(q_ml_curated(spark, sf_dir), ["email", "rn"], 10)


# Fixed values of the upsert scenario: customer landing records are spread
# over commits 1, 2 and 4 by device parity and registration date modulo 3 (all of them, no filter on the
# whole), and commit 3 deletes every device whose latest record has no research
# consent (a withdrawal).
def _commit_of() -> Column:
    even = F.when(F.col("serialnumber") % 2 == 0, 1).otherwise(2)
    third = F.when(F.col("registrationdate") % 3 == 0, 1).otherwise(2)
    return (even * third).cast("long")


def _customer_commits(spark: SparkSession, sf_dir: str, deletes: bool) -> ZoneStore:
    """The customer feed as upserts 1, 2 and 4 (3 without the deletes between) of a stored table."""

    def make(folder: str) -> ZoneStore:
        store = ZoneStore(folder, Zones("q" + folder.rsplit("-", 1)[1]))
        feed = landing(spark, sf_dir, "customer_landing")
        for n in (1, 2, 4):
            if n == 4 and deletes:
                latest = keep_latest(feed, "serialnumber", "registrationdate")
                store.delete(latest.where(F.col("sharewithresearchasofdate").isNull()), "trusted", "customer")
            store.write(feed.where(_commit_of() == n), "trusted", "customer", "serialnumber", "registrationdate", mode="upsert")
        return store

    return _once(spark, sf_dir, "commits-with-deletes" if deletes else "commits", make)


def q_upsert_current(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _customer_commits(spark, sf_dir, False).read(spark, "trusted", "customer")


def q_as_of_commit_2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """By the table function of the log."""
    return spark.sql(f"SELECT * FROM {_customer_commits(spark, sf_dir, True).zones.database('trusted')}__customer__as_of(2)")


def q_changes_since_commit_2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(f"SELECT * FROM {_customer_commits(spark, sf_dir, True).zones.database('trusted')}__customer__changes(2)")


def q_upsert_with_deletes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_zone(spark, "trusted", "customer", _customer_commits(spark, sf_dir, True).zones)


def q_replaced_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table that held every customer record's device, replaced by the trusted customers."""

    def make(folder: str) -> ZoneStore:
        store = ZoneStore(folder, Zones("q" + folder.rsplit("-", 1)[1]))
        feed = landing(spark, sf_dir, "customer_landing")
        store.write(feed.withColumn("customername", F.upper("customername")), "trusted", "customer", "serialnumber", "registrationdate")
        store.write(refine.customer_trusted(feed), "trusted", "customer", "serialnumber", "registrationdate")
        return store

    return read_zone(spark, "trusted", "customer", _once(spark, sf_dir, "replaced", make).zones)


def q_replaced_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The latest record of every device in four partitions, two of which are replaced by their consenting devices."""

    def make(folder: str) -> str:
        feed = landing(spark, sf_dir, "customer_landing").withColumn("part", (F.col("serialnumber") % 4).cast("int"))
        name = f"q{folder.rsplit('-', 1)[1]}_trusted.customer_parts"
        replace_partitions(feed, folder, "part", "serialnumber", "registrationdate", name=name)
        latest = keep_latest(feed, "serialnumber", "registrationdate").filter("part IN (1, 2) AND sharewithresearchasofdate IS NOT NULL")
        replace_partitions(latest.withColumn("phone", F.lit(None).cast("string")), folder, "part", "serialnumber", "registrationdate", name=name)
        return name

    return spark.table(_once(spark, sf_dir, "partitions", make))


def q_evolved_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three commits of customer records: the second one adds ``share``, the third one widens ``days`` (int to bigint) and
    ``share`` (float to double)."""

    def make(folder: str) -> ZoneStore:
        store = ZoneStore(folder, Zones("q" + folder.rsplit("-", 1)[1]))
        feed = landing(spark, sf_dir, "customer_landing")
        days, share = F.floor(F.col("registrationdate") / 86_400_000), F.col("serialnumber") % 8 / 8
        shapes = {1: {"days": days.cast("int")}, 2: {"days": days.cast("int"), "share": share.cast("float")}, 4: {"days": F.col("registrationdate"), "share": share / 1024}}
        for n, columns in shapes.items():
            rows = feed.where(_commit_of() == n).select("serialnumber", "registrationdate", *[c.alias(k) for k, c in columns.items()])
            store.write(rows, "trusted", "customer", "serialnumber", "registrationdate", mode="upsert")
        return store

    return read_zone(spark, "trusted", "customer", _once(spark, sf_dir, "evolved", make).zones)


def q_ml_curated_persisted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feature table with the device table held in executor memory, as the original job's option."""
    customers, accel, steps = _trusted(spark, sf_dir)
    return refine.ml_curated(steps, accel, customers, persist=True)


def q_run_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Row count and schema of each table that the jobs stored, read through the catalog."""
    zones = _lake(spark, sf_dir).zones
    stored = {n: read_zone(spark, "curated" if n in ("customer_curated", "machine_learning_curated") else "trusted", n, zones) for n in refine.TABLE_KEYS}
    return report(stored)


def q_zone_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the stored tables by their files and by the catalog's statistics, and whether files and bytes are known."""
    zones, frames = _lake(spark, sf_dir).zones, []
    for table in refine.TABLE_KEYS:
        name = f"{zones.database('curated' if table in ('customer_curated', 'machine_learning_curated') else 'trusted')}.{table}__rows"
        size, records = analyze_table(spark, name)
        stats = file_statistics(spark.table(name), table)
        frames.append(stats.select("table_name", "records", F.lit(records).cast("long").alias("catalog_records"), ((F.col("objects") > 0) & (F.col("size_bytes") <= size)).alias("sized")))
    return checks.union_all(frames)


def q_numbering_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The numbered tables as they are stored: every key's rows are numbered once each, without a gap."""
    zones = _lake(spark, sf_dir).zones
    keys = {"accelerometer_trusted": ("trusted", "user"), "step_trainer_trusted": ("trusted", "serialnumber"), "machine_learning_curated": ("curated", "email")}
    return checks.union_all([checks.numbering_violations(read_zone(spark, zone, t, zones), key, table_name=t) for t, (zone, key) in keys.items()])


def q_count_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the stored tables against what the landing feeds lead to, counted from keys without making the rows."""
    zones = _lake(spark, sf_dir).zones
    stored = {n: read_zone(spark, "curated" if n in ("customer_curated", "machine_learning_curated") else "trusted", n, zones) for n in refine.TABLE_KEYS}
    feeds = {n: landing(spark, sf_dir, n) for n in mapped.FEEDS}
    customers = consent_filter(feeds["customer_landing"])
    devices = keep_latest(customers, "serialnumber", "registrationdate").select("serialnumber", "email")
    per_email, per_device = (devices.groupBy(c).agg(F.count(F.lit(1)).alias("n")) for c in ("email", "serialnumber"))
    readings = feeds["accelerometer_landing"].groupBy("user", "timestamp").agg(F.count(F.lit(1)).alias("m"))
    readings = readings.join(per_email, F.col("user") == F.col("email")).select("user", "timestamp", (F.col("m") * F.col("n")).alias("m"))
    steps = feeds["step_trainer_landing"].join(per_device, "serialnumber")
    owners = devices.join(readings, F.col("email") == F.col("user"), "left_semi")
    owned = feeds["step_trainer_landing"].select("sensorreadingtime", "serialnumber", "distancefromobject").distinct().join(owners, "serialnumber")
    at = readings.groupBy("timestamp").agg(F.sum("m").alias("m"))
    counts = {
        "customer_trusted": customers.agg(F.count_distinct("serialnumber").alias("expected")),
        "accelerometer_trusted": readings.agg(F.sum("m").alias("expected")),
        "step_trainer_trusted": steps.agg(F.sum("n").alias("expected")),
        "customer_curated": owners.agg(F.count(F.lit(1)).alias("expected")),
        "machine_learning_curated": owned.join(at, F.col("sensorreadingtime") == F.col("timestamp")).agg(F.sum("m").alias("expected")),
    }
    return checks.count_check(stored, checks.union_all([df.select(F.lit(t).alias("table_name"), F.coalesce("expected", F.lit(0)).cast("long").alias("expected")) for t, df in counts.items()]))


QUERIES: dict[str, Query] = {
    "customer_landing": lambda s, d: landing(s, d, "customer_landing"),
    "accelerometer_landing": lambda s, d: landing(s, d, "accelerometer_landing"),
    "step_trainer_landing": lambda s, d: landing(s, d, "step_trainer_landing"),
    "landing_counts": q_landing_counts,
    "consent_filter": q_consent_filter,
    "customer_trusted": _customer_trusted,
    "accelerometer_trusted": lambda s, d: _accel_trusted(configure(s), d),
    "step_trainer_trusted": lambda s, d: _step_trusted(configure(s), d),
    "customer_reading_fanout": q_customer_reading_fanout,
    "customer_curated": q_customer_curated,
    "device_readings_with_owner": q_device_readings_with_owner,
    "device_readings_raw_lineage": q_device_readings_raw_lineage,
    "ml_curated": q_ml_curated,
    "ml_curated_from_landing": q_ml_curated_from_landing,
    "ml_curated_same_user": lambda s, d: q_ml_curated(s, d, same_user=True),
    "catalog_customer_landing": _cataloged("customer_landing"),
    "catalog_accelerometer_landing": _cataloged("accelerometer_landing"),
    "catalog_step_trainer_landing": _cataloged("step_trainer_landing"),
    "single_file_landing": q_single_file_landing,
    "landing_stats": q_landing_stats,
    "landing_schemas": q_landing_schemas,
    "stored_customer_trusted": _stored("trusted", "customer_trusted"),
    "stored_accelerometer_trusted": _stored("trusted", "accelerometer_trusted"),
    "stored_step_trainer_trusted": _stored("trusted", "step_trainer_trusted"),
    "stored_customer_curated": _stored("curated", "customer_curated"),
    "stored_machine_learning_curated": _stored("curated", "machine_learning_curated"),
    "zone_counts": q_zone_counts,
    "consent_check": q_consent_check,
    "key_check": q_key_check,
    "preview_customer_trusted": q_preview_customer_trusted,
    "preview_ml_curated": q_preview_ml_curated,
    "upsert_current": q_upsert_current,
    "as_of_commit_2": q_as_of_commit_2,
    "changes_since_commit_2": q_changes_since_commit_2,
    "upsert_with_deletes": q_upsert_with_deletes,
    "replaced_table": q_replaced_table,
    "replaced_partitions": q_replaced_partitions,
    "evolved_table": q_evolved_table,
    "ml_curated_persisted": q_ml_curated_persisted,
    "run_report": q_run_report,
    "zone_statistics": q_zone_statistics,
    "numbering_check": q_numbering_check,
    "count_check": q_count_check,
}


# ----------------------------------------------------------------------- SQL

_MS_DAY = "epoch_ms(o_orderdate)"
_MINUTE = "CAST(floor(epoch_ms(ts) / 60000) * 60000 AS BIGINT)"
_K = "TRY_CAST(json_extract_string(props, '$.k') AS INTEGER)"

CUSTOMER_LANDING_SQL = f"""
SELECT 'Customer ' || CAST(o_custkey AS VARCHAR) AS customername,
       CAST(floor(o_custkey / 2) AS BIGINT) AS email,
       '555-' || CAST(o_custkey AS VARCHAR) AS phone,
       CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS birthday,
       o_custkey AS serialnumber,
       {_MS_DAY} + o_orderkey AS registrationdate,
       {_MS_DAY} AS lastupdatedate,
       CASE WHEN o_orderstatus <> 'F' THEN {_MS_DAY} END AS sharewithresearchasofdate,
       CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN {_MS_DAY} END AS sharewithpublicasofdate,
       CASE WHEN o_orderstatus = 'O' THEN {_MS_DAY} END AS sharewithfriendsasofdate
FROM orders"""

ACCEL_LANDING_SQL = f"""
SELECT user_id AS "user", {_MINUTE} AS "timestamp", value AS x, value * 2 AS y,
       CAST({_K} AS DOUBLE) AS z
FROM events WHERE event_type IN ('click', 'view', 'purchase')"""

STEP_LANDING_SQL = f"""
SELECT {_MINUTE} AS sensorreadingtime, user_id AS serialnumber, {_K} AS distancefromobject
FROM events WHERE event_type IN ('error', 'signup')"""

_CUSTOMER_COLS = (
    "customername, email, phone, birthday, serialnumber, registrationdate, lastupdatedate, "
    "sharewithresearchasofdate, sharewithpublicasofdate, sharewithfriendsasofdate"
)
_CUSTOMER_TYPES = ",".join(f"{c}:{'string' if c in ('customername', 'phone', 'birthday') else 'bigint'}" for c in _CUSTOMER_COLS.split(", "))
_LATEST_CUSTOMER = (
    "row_number() OVER (PARTITION BY serialnumber ORDER BY registrationdate DESC NULLS LAST, "
    "customername DESC NULLS LAST, email DESC NULLS LAST, phone DESC NULLS LAST, birthday DESC NULLS LAST, "
    "lastupdatedate DESC NULLS LAST, sharewithresearchasofdate DESC NULLS LAST, "
    "sharewithpublicasofdate DESC NULLS LAST, sharewithfriendsasofdate DESC NULLS LAST) = 1"
)

# The trusted and curated zones as one chain of CTEs over the landing tables
# customer_landing, accelerometer_landing and step_trainer_landing, written
# like the original jobs: join, then keep-latest / distinct, then row_number.
JOBS_SQL = f"""
consenting AS (SELECT * FROM customer_landing WHERE sharewithresearchasofdate IS NOT NULL),
customer_trusted AS (SELECT * FROM consenting QUALIFY {_LATEST_CUSTOMER}),
accelerometer_trusted AS (
  SELECT a."user", a."timestamp", a.x, a.y, a.z,
         row_number() OVER (PARTITION BY a."user" ORDER BY a."timestamp" NULLS FIRST, a.x NULLS FIRST,
                            a.y NULLS FIRST, a.z NULLS FIRST) AS rn
  FROM accelerometer_landing a JOIN customer_trusted c ON a."user" = c.email),
step_trainer_trusted AS (
  SELECT s.sensorreadingtime, s.serialnumber, s.distancefromobject,
         row_number() OVER (PARTITION BY s.serialnumber ORDER BY s.sensorreadingtime NULLS FIRST,
                            s.distancefromobject NULLS FIRST) AS rn
  FROM step_trainer_landing s JOIN customer_trusted c ON s.serialnumber = c.serialnumber),
curated_join AS (
  SELECT c.customername, c.email, c.phone, c.birthday, c.serialnumber, c.registrationdate, c.lastupdatedate,
         c.sharewithresearchasofdate, c.sharewithpublicasofdate, c.sharewithfriendsasofdate
  FROM accelerometer_trusted a JOIN customer_trusted c ON a."user" = c.email),
customer_curated AS (SELECT * FROM curated_join QUALIFY {_LATEST_CUSTOMER}),
device_readings AS (
  SELECT DISTINCT st.sensorreadingtime, st.serialnumber, st.distancefromobject, cc.email, cc.registrationdate
  FROM step_trainer_trusted st JOIN curated_join cc ON st.serialnumber = cc.serialnumber),
ml_pairs AS (
  SELECT jd.email, jd.sensorreadingtime, jd.serialnumber, jd.distancefromobject, a.x, a.y, a.z, a."user"
  FROM device_readings jd JOIN accelerometer_trusted a ON jd.sensorreadingtime = a."timestamp"),
machine_learning_curated AS (
  SELECT email, sensorreadingtime, serialnumber, distancefromobject, x, y, z,
         row_number() OVER (PARTITION BY email ORDER BY sensorreadingtime NULLS FIRST, serialnumber NULLS FIRST,
                            distancefromobject NULLS FIRST, x NULLS FIRST, y NULLS FIRST, z NULLS FIRST) AS rn
  FROM ml_pairs),
ml_same_user AS (
  SELECT email, sensorreadingtime, serialnumber, distancefromobject, x, y, z,
         row_number() OVER (PARTITION BY email ORDER BY sensorreadingtime NULLS FIRST, serialnumber NULLS FIRST,
                            distancefromobject NULLS FIRST, x NULLS FIRST, y NULLS FIRST, z NULLS FIRST) AS rn
  FROM ml_pairs WHERE email = "user")
"""

CHAIN_SQL = f"""
WITH customer_landing AS ({CUSTOMER_LANDING_SQL}),
accelerometer_landing AS ({ACCEL_LANDING_SQL}),
step_trainer_landing AS ({STEP_LANDING_SQL}),
{JOBS_SQL}"""



def _chain(select: str) -> str:
    return CHAIN_SQL + select


_LOG_SQL = f"""
WITH customer_landing AS ({CUSTOMER_LANDING_SQL}),
log AS (
  SELECT *, CAST((CASE WHEN serialnumber % 2 = 0 THEN 1 ELSE 2 END)
               * (CASE WHEN registrationdate % 3 = 0 THEN 1 ELSE 2 END) AS BIGINT) AS _commit,
         false AS _deleted
  FROM customer_landing),
log_d AS (
  SELECT * FROM log
  UNION ALL
  SELECT NULL, NULL, NULL, NULL, serialnumber, NULL, NULL, NULL, NULL, NULL, CAST(3 AS BIGINT), true
  FROM (SELECT * FROM customer_landing QUALIFY row_number() OVER (
          PARTITION BY serialnumber ORDER BY registrationdate DESC NULLS LAST) = 1)
  WHERE sharewithresearchasofdate IS NULL)
"""

_LATEST_IN_LOG = (
    "row_number() OVER (PARTITION BY serialnumber ORDER BY _commit DESC NULLS LAST, "
    "registrationdate DESC NULLS LAST, customername DESC NULLS LAST, email DESC NULLS LAST, phone DESC NULLS LAST, "
    "birthday DESC NULLS LAST, lastupdatedate DESC NULLS LAST, sharewithresearchasofdate DESC NULLS LAST, "
    "sharewithpublicasofdate DESC NULLS LAST, sharewithfriendsasofdate DESC NULLS LAST, "
    "_deleted DESC NULLS LAST) = 1"
)

ORACLE_SQL: dict[str, str] = {
    "customer_landing": CUSTOMER_LANDING_SQL,
    "accelerometer_landing": ACCEL_LANDING_SQL,
    "step_trainer_landing": STEP_LANDING_SQL,
    "landing_counts": f"""
WITH customer_landing AS ({CUSTOMER_LANDING_SQL}),
accelerometer_landing AS ({ACCEL_LANDING_SQL}),
step_trainer_landing AS ({STEP_LANDING_SQL})
SELECT 'customer_landing' AS table_name, count(*) AS row_count FROM customer_landing
UNION ALL SELECT 'accelerometer_landing', count(*) FROM accelerometer_landing
UNION ALL SELECT 'step_trainer_landing', count(*) FROM step_trainer_landing""",
    "consent_filter": f"SELECT * FROM ({CUSTOMER_LANDING_SQL}) WHERE sharewithresearchasofdate IS NOT NULL",
    "customer_trusted": _chain("SELECT * FROM customer_trusted"),
    "accelerometer_trusted": _chain("SELECT * FROM accelerometer_trusted"),
    "step_trainer_trusted": _chain("SELECT * FROM step_trainer_trusted"),
    "customer_reading_fanout": _chain(
        "SELECT serialnumber, count(*) AS readings FROM curated_join GROUP BY serialnumber"
    ),
    "customer_curated": _chain("SELECT * FROM customer_curated"),
    "device_readings_with_owner": _chain("SELECT * FROM device_readings"),
    "device_readings_raw_lineage": _chain("SELECT * FROM device_readings"),
    "ml_curated": _chain("SELECT * FROM machine_learning_curated"),
    "ml_curated_from_landing": _chain("SELECT * FROM machine_learning_curated"),
    "ml_curated_same_user": _chain("SELECT * FROM ml_same_user"),
    "catalog_customer_landing": CUSTOMER_LANDING_SQL,
    "catalog_accelerometer_landing": ACCEL_LANDING_SQL,
    "catalog_step_trainer_landing": STEP_LANDING_SQL,
    "landing_stats": " UNION ALL ".join(
        f"SELECT '{n}' AS table_name, count(*) AS records, CAST(0 AS BIGINT) AS malformed FROM ({q})"
        for n, q in (("customer_landing", CUSTOMER_LANDING_SQL), ("accelerometer_landing", ACCEL_LANDING_SQL), ("step_trainer_landing", STEP_LANDING_SQL))
    ),
    # an inferred schema has a bigint for every whole number; columns that are null in all rows are absent from the files
    "landing_schemas": " UNION ALL ".join(
        f"SELECT '{n}' AS table_name, column_name, CASE WHEN column_type = 'VARCHAR' THEN 'string' ELSE lower(replace(column_type, 'INTEGER', 'BIGINT')) END AS data_type FROM (DESCRIBE {q})"
        for n, q in (("customer_landing", CUSTOMER_LANDING_SQL), ("accelerometer_landing", ACCEL_LANDING_SQL), ("step_trainer_landing", STEP_LANDING_SQL))
    ),
    "stored_customer_trusted": _chain("SELECT * FROM customer_trusted"),
    "stored_accelerometer_trusted": _chain("SELECT * FROM accelerometer_trusted"),
    "stored_step_trainer_trusted": _chain("SELECT * FROM step_trainer_trusted"),
    "stored_customer_curated": _chain("SELECT * FROM customer_curated"),
    "stored_machine_learning_curated": _chain("SELECT * FROM machine_learning_curated"),
    "zone_counts": _chain(
        """SELECT 'customer_trusted' AS table_name, count(*) AS row_count FROM customer_trusted
UNION ALL SELECT 'accelerometer_trusted', count(*) FROM accelerometer_trusted
UNION ALL SELECT 'step_trainer_trusted', count(*) FROM step_trainer_trusted
UNION ALL SELECT 'customer_curated', count(*) FROM customer_curated
UNION ALL SELECT 'machine_learning_curated', count(*) FROM machine_learning_curated"""
    ),
    "consent_check": _chain(
        "SELECT count(*) AS checked_rows, count(*) FILTER (WHERE sharewithresearchasofdate IS NULL) "
        "AS missing_consent FROM customer_trusted"
    ),
    "key_check": _chain(
        """, key_counts AS (
  SELECT 'customer_trusted' AS table_name, serialnumber IS NULL AS has_null, count(*) AS n
  FROM customer_trusted GROUP BY serialnumber
  UNION ALL SELECT 'accelerometer_trusted', "user" IS NULL OR rn IS NULL, count(*)
  FROM accelerometer_trusted GROUP BY "user", rn
  UNION ALL SELECT 'step_trainer_trusted', serialnumber IS NULL OR rn IS NULL, count(*)
  FROM step_trainer_trusted GROUP BY serialnumber, rn
  UNION ALL SELECT 'customer_curated', serialnumber IS NULL, count(*) FROM customer_curated GROUP BY serialnumber
  UNION ALL SELECT 'machine_learning_curated', email IS NULL OR rn IS NULL, count(*)
  FROM machine_learning_curated GROUP BY email, rn)
SELECT table_name, CAST(coalesce(sum(n) FILTER (WHERE has_null), 0) AS BIGINT) AS null_keys,
       count(*) FILTER (WHERE NOT has_null AND n > 1) AS duplicate_keys
FROM key_counts GROUP BY table_name"""
    ),
    "preview_customer_trusted": _chain("SELECT * FROM customer_trusted ORDER BY serialnumber LIMIT 5"),
    "preview_ml_curated": _chain("SELECT * FROM machine_learning_curated ORDER BY email, rn LIMIT 10"),
    "upsert_current": _LOG_SQL
    + f"SELECT {_CUSTOMER_COLS} FROM log QUALIFY {_LATEST_IN_LOG}",
    "as_of_commit_2": _LOG_SQL
    + f"SELECT {_CUSTOMER_COLS} FROM (SELECT * FROM log WHERE _commit <= 2) QUALIFY {_LATEST_IN_LOG}",
    "changes_since_commit_2": _LOG_SQL
    + f"SELECT * FROM (SELECT * FROM log_d WHERE _commit > 2) QUALIFY {_LATEST_IN_LOG}",
    "upsert_with_deletes": _LOG_SQL
    + f"SELECT {_CUSTOMER_COLS} FROM (SELECT * FROM log_d QUALIFY {_LATEST_IN_LOG}) WHERE NOT _deleted",
    "replaced_table": _chain("SELECT * FROM customer_trusted"),
    "replaced_partitions": f"""
WITH customer_landing AS ({CUSTOMER_LANDING_SQL}),
latest AS (SELECT *, CAST(serialnumber % 4 AS INTEGER) AS part FROM customer_landing QUALIFY {_LATEST_CUSTOMER})
SELECT * FROM latest WHERE part IN (0, 3)
UNION ALL
SELECT * REPLACE (CAST(NULL AS VARCHAR) AS phone) FROM latest WHERE part IN (1, 2) AND sharewithresearchasofdate IS NOT NULL""",
    "evolved_table": _LOG_SQL
    + """
SELECT serialnumber, registrationdate, CASE WHEN _commit < 4 THEN CAST(floor(registrationdate / 86400000) AS BIGINT) ELSE registrationdate END AS days,
       CASE _commit WHEN 2 THEN serialnumber % 8 / 8.0::DOUBLE WHEN 4 THEN serialnumber % 8 / 8.0::DOUBLE / 1024 END AS share
FROM log QUALIFY row_number() OVER (PARTITION BY serialnumber ORDER BY _commit DESC, registrationdate DESC) = 1""",
    "ml_curated_persisted": _chain("SELECT * FROM machine_learning_curated"),
    "run_report": _chain(
        "SELECT table_name, row_count, columns FROM ("
        + " UNION ALL ".join(
            f"SELECT '{t}' AS table_name, count(*) AS row_count, 'struct<{c}>' AS columns FROM {t}"
            for t, c in {
                "customer_trusted": _CUSTOMER_TYPES,
                "accelerometer_trusted": "user:bigint,timestamp:bigint,x:double,y:double,z:double,rn:bigint",
                "step_trainer_trusted": "sensorreadingtime:bigint,serialnumber:bigint,distancefromobject:int,rn:bigint",
                "customer_curated": _CUSTOMER_TYPES,
                "machine_learning_curated": "email:bigint,sensorreadingtime:bigint,serialnumber:bigint,distancefromobject:int,x:double,y:double,z:double,rn:bigint",
            }.items()
        )
        + ")"
    ),
    "single_file_landing": CUSTOMER_LANDING_SQL,
    "zone_statistics": _chain(
        "SELECT table_name, n AS records, n AS catalog_records, true AS sized FROM ("
        + " UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS n FROM {t}" for t in refine.TABLE_KEYS)
        + ")"
    ),
    "numbering_check": _chain(
        " UNION ALL ".join(
            f"SELECT '{t}' AS table_name, count(*) FILTER ({k} IS NULL OR rn IS NULL) AS null_keys, count(*) - count(DISTINCT struct_pack(k := {k}, rn := rn)) AS repeated, "
            f"CAST(coalesce((SELECT sum(last) FROM (SELECT max(rn) AS last FROM {t} GROUP BY {k})), 0) AS BIGINT) - count(DISTINCT struct_pack(k := {k}, rn := rn)) AS missing FROM {t}"
            for t, k in {"accelerometer_trusted": '"user"', "step_trainer_trusted": "serialnumber", "machine_learning_curated": "email"}.items()
        )
    ),
    "count_check": _chain(
        "SELECT table_name, n AS row_count, n AS expected, true AS ok FROM ("
        + " UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS n FROM {t}" for t in refine.TABLE_KEYS)
        + ")"
    ),
}
