"""Reproduce the skew measurements quoted in the README.

A skewed accelerometer feed is derived from the ``events`` test table: every
event is repeated ``--copies`` times with distinct times, and one user takes a
third of all rows.  The accelerometer-trusted job then runs twice: in the
shape of the original job (inner join, ``row_number`` window) and with this
library (``refine.accelerometer_trusted``) at a hot-key threshold scaled to
the input.  Both results are compared row for row, and the largest number of
shuffled rows read by one task is taken from Spark's event log.

    python tools/skew_check.py [--sf-dir /root/testdata/sf0.1] [--copies 30]
"""

from __future__ import annotations

import argparse
import glob
import io
import json
import os
import sys
import tempfile
import time
from collections import defaultdict

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession, Window  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

import zonelake.operators.skew as skew  # noqa: E402
from zonelake.functions.columns import epoch_millis, json_int  # noqa: E402
from zonelake.plans import refine  # noqa: E402
from zonelake.session import configure  # noqa: E402


def _events(log_dir: str):
    import zstandard

    for path in sorted(glob.glob(f"{log_dir}/*/events_*")):
        raw = open(path, "rb").read()
        if path.endswith(".zstd"):
            raw = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(raw)).read()
        for line in raw.decode().splitlines():
            yield json.loads(line)


def _max_task_reads(log_dir: str) -> dict[str, int]:
    """Largest shuffle read (rows) of one task, per job description."""
    stage_job: dict[int, str] = {}
    worst: dict[str, int] = defaultdict(int)
    for e in _events(log_dir):
        if e["Event"] == "SparkListenerJobStart":
            desc = e.get("Properties", {}).get("spark.job.description", "")
            for s in e["Stage Infos"]:
                stage_job[s["Stage ID"]] = desc
        elif e["Event"] == "SparkListenerTaskEnd":
            read = (e.get("Task Metrics") or {}).get("Shuffle Read Metrics", {}).get("Total Records Read", 0)
            desc = stage_job.get(e["Stage ID"], "")
            worst[desc] = max(worst[desc], read)
    return dict(worst)


def main() -> None:
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf-dir", default="/root/testdata/sf0.1")
    ap.add_argument("--copies", type=int, default=30)
    ap.add_argument("--partitions", type=int, default=32)
    args = ap.parse_args()
    scratch = tempfile.mkdtemp(prefix="zonelake-skew-")
    log_dir = os.path.join(scratch, "events")
    os.makedirs(log_dir)
    spark = (
        SparkSession.builder.master("local[8]")
        .appName("zonelake-skew-check")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(args.partitions))
        .config("spark.eventLog.enabled", "true")
        .config("spark.eventLog.dir", log_dir)
        .config("spark.checkpoint.dir", os.path.join(scratch, "checkpoints"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    configure(spark)

    events = spark.read.parquet(f"{args.sf_dir}/events.parquet").where(F.col("event_type").isin("click", "view", "purchase"))
    copy = F.explode(F.sequence(F.lit(0), F.lit(args.copies - 1))).alias("copy")
    rep = events.select("*", copy)
    readings = rep.select(
        F.when(F.col("copy") % 3 == 0, F.lit(0)).otherwise(F.col("user_id") + 1 + 10_000 * F.col("copy")).alias("user"),
        (epoch_millis("ts") + F.col("copy")).alias("timestamp"),
        F.col("value").alias("x"),
        (F.col("value") * 2).alias("y"),
        json_int("props", "k").cast("double").alias("z"),
    )
    readings_path = os.path.join(scratch, "readings")
    readings.write.parquet(readings_path)
    readings = spark.read.parquet(readings_path)
    users = readings.select("user").distinct()
    customers = users.select(
        F.col("user").alias("email"), F.explode(F.array(F.col("user") * 2, F.col("user") * 2 + 1)).alias("serialnumber")
    ).withColumn("sharewithresearchasofdate", F.lit(1).cast("long"))
    customers_path = os.path.join(scratch, "customers")
    customers.write.parquet(customers_path)
    customers = spark.read.parquet(customers_path)
    total = readings.count()

    spark.sparkContext.setJobDescription("original shape")
    t0 = time.perf_counter()
    joined = readings.join(customers, F.col("user") == F.col("email")).select("user", "timestamp", "x", "y", "z")
    w = Window.partitionBy("user").orderBy("timestamp", "x", "y", "z")
    plain = joined.withColumn("rn", F.row_number().over(w).cast("long"))
    plain_path = os.path.join(scratch, "plain")
    plain.write.parquet(plain_path)
    t_plain = time.perf_counter() - t0

    skew.HOT_ROWS = max(1, (total * 2) // (4 * args.partitions))  # scaled to this input: ~4 partitions' worth
    spark.sparkContext.setJobDescription("zonelake")
    t0 = time.perf_counter()
    ours = refine.accelerometer_trusted(readings, customers)
    ours_path = os.path.join(scratch, "ours")
    ours.write.parquet(ours_path)
    t_ours = time.perf_counter() - t0

    spark.sparkContext.setJobDescription("compare")
    a, b = spark.read.parquet(plain_path), spark.read.parquet(ours_path)
    diff = a.exceptAll(b).count() + b.exceptAll(a).count()
    spark.stop()
    worst = _max_task_reads(log_dir)
    print(
        json.dumps(
            {
                "input_rows": total,
                "output_rows": 2 * total,
                "hot_user_share": "1/3",
                "hot_rows_threshold": skew.HOT_ROWS,
                "rows_differing": diff,
                "original_shape": {"seconds": round(t_plain, 2), "max_rows_one_task": worst.get("original shape")},
                "zonelake": {"seconds": round(t_ours, 2), "max_rows_one_task": worst.get("zonelake")},
            }
        )
    )


if __name__ == "__main__":
    main()
