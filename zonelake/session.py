"""Session settings the library relies on.

The session itself belongs to the caller (a cluster job, the test suite or
the driver); ``configure`` only sets what the results or the plans depend on.
"""

from __future__ import annotations

import os
import tempfile
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from typing import Any

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

# Settings applied to every session handed to the library.  The time zone
# matters for values (epoch conversions); the rest shape the physical plans:
# AQE re-plans joins from runtime sizes, splits skewed join partitions and
# coalesces small shuffle partitions.
SESSION_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # split a skewed join even when its consumer then needs one more shuffle:
    # the counts and windows above the gate joins group by the join key, and
    # without this AQE would leave a hot user's rows in one join task
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # JSON keys are camelCase while the refined tables are lower case; the
    # landing reads rely on case-insensitive resolution.
    "spark.sql.caseSensitive": "false",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply ``SESSION_SETTINGS`` to ``spark`` and return it."""
    for key, value in SESSION_SETTINGS.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def shuffle_partitions(spark: SparkSession) -> int:
    """Partition count for operator-level repartitioning (follows the session)."""
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for lineage cuts.

    The cluster names it in ``spark.checkpoint.dir``.  Only a local-mode
    session (tests, the bench) without one gets a private folder; on a
    cluster a missing setting is an error, since a machine-local folder is
    not readable from the other executors.
    """
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        configured = tempfile.mkdtemp(prefix="zonelake-ckpt-")
    spark.sparkContext.setCheckpointDir(configured)  # makes a fresh subfolder per application
    return spark.sparkContext.getCheckpointDir() or configured


def at_once(spark: SparkSession, *jobs: Callable[[], Any]) -> list:
    """The results of independent ``jobs``, each started in a thread of its own with the caller's local properties: while the
    tail of one stage holds few cores, the other's tasks take the free ones (``spark.scheduler.mode`` FAIR shares them
    evenly).  All are waited for; the first failure is raised."""
    with ThreadPoolExecutor(len(jobs)) as pool:
        started = [pool.submit(inheritable_thread_target(spark)(job)) for job in jobs]
    return [s.result() for s in started]


def local_session(app: str = "zonelake", cores: str = "*", partitions: int = 8) -> SparkSession:
    """A local session for tests and the bench (no UI, small shuffle count)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.driver.memory", os.environ.get("ZONELAKE_DRIVER_MEMORY", "8g"))
        .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="zonelake-wh-"))
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def materialize(df: DataFrame) -> DataFrame:
    """Write ``df`` once to the shared checkpoint folder and read it from there
    (a lineage cut: later actions and lost executors do not recompute it)."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def materialize_counted(df: DataFrame, size: Column) -> tuple[DataFrame, int, int]:
    """``materialize`` that also returns the row count and the sum of ``size``, observed while the
    rows are written (no second job)."""
    seen = Observation()
    out = materialize(df.observe(seen, F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum(size), F.lit(0)).alias("size")))
    return out, int(seen.get["rows"]), int(seen.get["size"])
