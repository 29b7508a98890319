"""Benchmark of the headline queries.

Runs each query on ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1) with
``local[$BENCH_CPUS]`` and prints one JSON line.  As in the baseline, every
query recomputes its whole lineage from the test tables and collects its
result to the driver; the JVM is warmed up on sf0.001 first (not timed).
Each query runs ``$BENCH_REPEAT`` times (default 3) and the median is
reported, since single runs on a shared VM vary by +-20%.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import SparkSession  # noqa: E402

from zonelake.plans.registry import QUERIES  # noqa: E402
from zonelake.session import configure  # noqa: E402

HEADLINE = [
    "customer_landing",
    "accelerometer_landing",
    "step_trainer_landing",
    "customer_trusted",
    "accelerometer_trusted",
    "step_trainer_trusted",
    "customer_curated",
    "ml_curated",
]
# timed too, not part of the headline sum: the same feature table without the trusted sensor tables, and the
# heaviest composites
MORE = ["ml_curated_from_landing", "zone_counts", "key_check"]


def _pipeline_seconds(spark: SparkSession, sf_dir: str, scratch: str, warm: bool = True) -> dict[str, float]:
    """The production path, timed once after a warm-up on sf0.001: the mapped
    feeds are written as JSON-lines landing files (untimed), then read with
    their schemas and refined into stored zone tables (timed, five commits)."""
    from zonelake import schemas
    from zonelake.plans.jobs import refine_all
    from zonelake.sinks.zone import ZoneStore
    from zonelake.sources import mapped
    from zonelake.sources.catalog import Zones
    from zonelake.sources.landing import read_landing

    warm_dir = os.path.join(os.path.dirname(sf_dir), "sf0.001")
    if warm and os.path.isdir(warm_dir) and warm_dir != sf_dir:
        _pipeline_seconds(spark, warm_dir, os.path.join(scratch, "warm"), warm=False)
    landing_dir = os.path.join(scratch, "landing")
    camel = {f.name.lower(): f.name for s in schemas.LANDING_SCHEMAS.values() for f in s.fields}
    for name, feed in mapped.FEEDS.items():
        df = feed(spark, sf_dir)
        df.toDF(*[camel.get(c.lower(), c) for c in df.columns]).write.mode("overwrite").json(f"{landing_dir}/{name}")
    t0 = time.perf_counter()
    landing = {
        n: read_landing(spark, f"{landing_dir}/{n}", schemas.LANDING_SCHEMAS[n], required=schemas.REQUIRED_KEYS[n]) for n in mapped.FEEDS
    }
    counts = refine_all(spark, landing, ZoneStore(os.path.join(scratch, "lake"), Zones(f"bench{int(warm)}")))
    rows = {r["table_name"]: r["row_count"] for r in counts.collect()}
    return {"refine_all_json_seconds": round(time.perf_counter() - t0, 3), "rows": rows}


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    scratch = tempfile.mkdtemp(prefix="zonelake-bench-")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("zonelake-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", os.environ.get("BENCH_PARTITIONS", str(int(cpus) * 2)))
        .config("spark.driver.memory", os.environ.get("BENCH_DRIVER_MEMORY", "16g"))
        .config("spark.sql.warehouse.dir", os.path.join(scratch, "warehouse"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    configure(spark)
    if not spark.conf.get("spark.checkpoint.dir", None):
        spark.sparkContext.setCheckpointDir(os.path.join(scratch, "checkpoints"))

    warm_dir = os.path.join(os.path.dirname(sf_dir), "sf0.001")
    if os.path.isdir(warm_dir):
        for name in HEADLINE:
            QUERIES[name](spark, warm_dir).collect()

    repeat = int(os.environ.get("BENCH_REPEAT", "3"))
    times: dict[str, float] = {}
    rows: dict[str, int] = {}
    for name in HEADLINE + MORE:
        runs = []
        for _ in range(repeat):
            t0 = time.perf_counter()
            result = QUERIES[name](spark, sf_dir).collect()
            runs.append(time.perf_counter() - t0)
            rows[name] = len(result)
        times[name] = round(statistics.median(runs), 3)
    pipeline = None
    if os.environ.get("BENCH_PIPELINE", "1") == "1":
        pipeline = _pipeline_seconds(spark, sf_dir, scratch)
    sf = os.path.basename(sf_dir).removeprefix("sf")
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(times[name] for name in HEADLINE), 3),
                "unit": "sec",
                "queries": {name: times[name] for name in HEADLINE},
                "more": {name: times[name] for name in MORE},
                "rows": rows,
                "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
                "cpus": int(cpus),
                "repeat": repeat,
                "pipeline": pipeline,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
