"""Landing schemas of the three raw feeds.

Column types follow the landing table definitions of the original lake; the
customer feed had no valid definition, so text columns are strings and the
date columns (epoch milliseconds) are longs.  JSON keys are camelCase in the
files; Spark resolves them case-insensitively, and ``lower_columns`` gives the
lower-case names of the refined zones.
"""

from __future__ import annotations

from pyspark.sql import types as T

ACCELEROMETER = T.StructType(
    [
        T.StructField("user", T.StringType()),
        T.StructField("timestamp", T.LongType()),
        T.StructField("x", T.DoubleType()),
        T.StructField("y", T.DoubleType()),
        T.StructField("z", T.DoubleType()),
    ]
)

STEP_TRAINER = T.StructType(
    [
        T.StructField("sensorReadingTime", T.LongType()),
        T.StructField("serialNumber", T.StringType()),
        T.StructField("distanceFromObject", T.IntegerType()),
    ]
)

CUSTOMER = T.StructType(
    [
        T.StructField("customerName", T.StringType()),
        T.StructField("email", T.StringType()),
        T.StructField("phone", T.StringType()),
        T.StructField("birthDay", T.StringType()),
        T.StructField("serialNumber", T.StringType()),
        T.StructField("registrationDate", T.LongType()),
        T.StructField("lastUpdateDate", T.LongType()),
        T.StructField("shareWithResearchAsOfDate", T.LongType()),
        T.StructField("shareWithPublicAsOfDate", T.LongType()),
        T.StructField("shareWithFriendsAsOfDate", T.LongType()),
    ]
)

# The ten customer columns of the curated customer table, in
# the order the curated job selects them.
CUSTOMER_COLUMNS = [
    "customername",
    "email",
    "phone",
    "birthday",
    "serialnumber",
    "registrationdate",
    "lastupdatedate",
    "sharewithresearchasofdate",
    "sharewithpublicasofdate",
    "sharewithfriendsasofdate",
]

ACCELEROMETER_COLUMNS = ["user", "timestamp", "x", "y", "z"]
STEP_TRAINER_COLUMNS = ["sensorreadingtime", "serialnumber", "distancefromobject"]
ML_COLUMNS = [
    "email",
    "sensorreadingtime",
    "serialnumber",
    "distancefromobject",
    "x",
    "y",
    "z",
]

# Name of the consent column: a customer shares data for research when it is
# present (its value is not inspected).
CONSENT_COLUMN = "sharewithresearchasofdate"

LANDING_SCHEMAS = {
    "customer_landing": CUSTOMER,
    "accelerometer_landing": ACCELEROMETER,
    "step_trainer_landing": STEP_TRAINER,
}

# Keys that some record of a feed must have: those the jobs join by and order by.
REQUIRED_KEYS = {
    "customer_landing": ["email", "serialNumber", "registrationDate"],
    "accelerometer_landing": ["user", "timestamp"],
    "step_trainer_landing": ["sensorReadingTime", "serialNumber"],
}
