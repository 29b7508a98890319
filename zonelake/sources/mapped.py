"""Landing-shaped feeds derived from the shared test tables.

The raw JSON of the lake is not available, so the three landing feeds are
derived from ``orders`` and ``events`` by a fixed mapping (documented in
FIXTURES.md §3).  Each function returns the feed with its JSON key names
(camelCase where the files use it); the landing step lower-cases them.

Keys are longs here (the JSON feeds carry strings); nothing downstream
depends on the key type.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from zonelake.functions.columns import epoch_millis, floor_to, json_int

# Fixed values of the mapping: event types standing for each sensor feed and
# the bucket (one minute, in ms) that reading times are rounded down to, so
# that equal times occur across the two feeds.
ACCELEROMETER_EVENTS = ["click", "view", "purchase"]
STEP_TRAINER_EVENTS = ["error", "signup"]
TIME_BUCKET_MS = 60_000


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _when_else_null(cond: Column, value: Column) -> Column:
    return F.when(cond, value)


def customer_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One customer record per order: device ``o_custkey`` registered by
    email ``o_custkey div 2`` (two devices share an email); orders with status
    F carry no research consent."""
    o = _table(spark, sf_dir, "orders")
    day_ms = epoch_millis("o_orderdate")
    return o.select(
        F.concat(F.lit("Customer "), F.col("o_custkey").cast("string")).alias("customerName"),
        F.floor(F.col("o_custkey") / 2).cast("long").alias("email"),
        F.concat(F.lit("555-"), F.col("o_custkey").cast("string")).alias("phone"),
        F.col("o_orderdate").cast("date").cast("string").alias("birthDay"),
        F.col("o_custkey").alias("serialNumber"),
        (day_ms + F.col("o_orderkey")).alias("registrationDate"),
        day_ms.alias("lastUpdateDate"),
        _when_else_null(F.col("o_orderstatus") != "F", day_ms).alias("shareWithResearchAsOfDate"),
        _when_else_null(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"), day_ms).alias("shareWithPublicAsOfDate"),
        _when_else_null(F.col("o_orderstatus") == "O", day_ms).alias("shareWithFriendsAsOfDate"),
    )


def _reading_time() -> Column:
    return floor_to(epoch_millis("ts"), TIME_BUCKET_MS)


def accelerometer_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Accelerometer readings: click/view/purchase events of ``user_id``."""
    e = _table(spark, sf_dir, "events").where(F.col("event_type").isin(*ACCELEROMETER_EVENTS))
    return e.select(
        F.col("user_id").alias("user"),
        _reading_time().alias("timestamp"),
        F.col("value").alias("x"),
        (F.col("value") * 2).alias("y"),
        json_int("props", "k").cast("double").alias("z"),
    )


def step_trainer_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Step-trainer readings: error/signup events of device ``user_id``."""
    e = _table(spark, sf_dir, "events").where(F.col("event_type").isin(*STEP_TRAINER_EVENTS))
    return e.select(
        _reading_time().alias("sensorReadingTime"),
        F.col("user_id").alias("serialNumber"),
        json_int("props", "k").alias("distanceFromObject"),
    )


FEEDS = {
    "customer_landing": customer_feed,
    "accelerometer_landing": accelerometer_feed,
    "step_trainer_landing": step_trainer_feed,
}
