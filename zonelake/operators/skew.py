"""Hot keys: keys holding more rows than one task should take.

Found in two steps, both combined map-side and so skew-safe themselves: rows are counted per hash bucket, of which there
is a fixed number however many keys there are, and keys are counted only in buckets that hold enough rows for a hot key.  Every hot key
is in such a bucket, so nothing is missed.  The largest ``MAX_HOT_KEYS`` of them are brought to the driver, a set small enough to
broadcast, and callers route the rows of those keys through a path that does
not gather them into one task.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Rows of one key that a single task may take (a few hundred MB of rows).
HOT_ROWS = 4_000_000
# Largest set of hot keys that is broadcast.
MAX_HOT_KEYS = 10_000
# Hash buckets of the first count.  With up to HOT_ROWS times as many rows the mean bucket is not hot; beyond that more keys than
# needed are counted.
HASH_BUCKETS = 1 << 20


def bound(spark: SparkSession | None, name: str, default: int) -> int:
    """A size bound: the session setting ``spark.zonelake.<name>`` when set,
    else ``default`` (the module constant, read at call time)."""
    if spark is not None:
        value = spark.conf.get(f"spark.zonelake.{name}", None)
        if value:
            return int(value)
    return default


def hot_threshold(threshold: int | None = None, spark: SparkSession | None = None) -> int:
    """``threshold``, or ``spark.zonelake.hotRows``, or ``HOT_ROWS``."""
    return bound(spark, "hotRows", HOT_ROWS) if threshold is None else threshold


def max_hot_keys(spark: SparkSession | None = None) -> int:
    """``spark.zonelake.maxHotKeys``, or ``MAX_HOT_KEYS``."""
    return bound(spark, "maxHotKeys", MAX_HOT_KEYS)


@dataclass(frozen=True)
class HotKeys:
    """The largest hot keys over ``keys``: ``frame`` holds at most ``MAX_HOT_KEYS`` of them, or is None if no key is hot.

    Any other key holds at most the hot threshold or, where more keys are hot, at most 1/``MAX_HOT_KEYS`` of all rows (it is not
    among the largest), so what is not split stays a bounded share of the input.
    """

    keys: tuple[str, ...]
    frame: DataFrame | None


def collect_hot(counts: DataFrame, keys: Sequence[str], size: str, *more: str) -> HotKeys:
    """The ``MAX_HOT_KEYS`` largest rows of ``counts`` (hot key tuples with their ``size``), brought to the driver in one job;
    ``more`` names columns that go along."""
    spark = counts.sparkSession
    columns = [*keys, *more]
    top = counts.orderBy(F.desc(size)).limit(max_hot_keys(spark)).select(*columns)
    rows = top.collect()
    return HotKeys(tuple(columns), spark.createDataFrame(rows, top.schema) if rows else None)


def no_hot_keys(keys: Sequence[str], rows: int, spark: SparkSession, threshold: int | None = None) -> HotKeys | None:
    """The empty set of hot keys if all ``rows`` together are within the threshold, so that no key can pass it; None if the keys
    have to be counted."""
    return HotKeys(tuple(keys), None) if rows <= hot_threshold(threshold, spark) else None


def find_hot_keys(
    df: DataFrame, keys: Sequence[str], *, weight: Column | None = None, threshold: int | None = None
) -> HotKeys:
    """Keys of ``df`` with more than ``threshold`` rows (or summed ``weight``, never negative);
    the threshold defaults to ``HOT_ROWS``.  ``df`` is read once, and a second time where a hash bucket is hot."""
    spark = df.sparkSession
    threshold = hot_threshold(threshold, spark)
    size = F.sum(weight) if weight is not None else F.count(F.lit(1))
    bucket = F.pmod(F.xxhash64(*keys), F.lit(HASH_BUCKETS))
    buckets = df.groupBy(bucket.alias("_bucket")).agg(size.alias("_n")).where(F.col("_n") > F.lit(threshold)).select("_bucket").toArrow()
    if not buckets.num_rows:
        return HotKeys(tuple(keys), None)
    if buckets.num_rows < HASH_BUCKETS:  # 8 MB at most
        df = df.join(F.broadcast(spark.createDataFrame(buckets)), bucket == F.col("_bucket"), "left_semi")
    counts = df.groupBy(*keys).agg(size.alias("_n")).where(F.col("_n") > F.lit(threshold))
    return collect_hot(counts, list(keys), "_n")


def matches_hot(df: DataFrame, hot: DataFrame, on: Sequence[str], hot_cols: Sequence[str]) -> Column:
    """Null-safe equality of ``df``'s ``on`` columns with the hot key columns."""
    return reduce(lambda a, b: a & b, [df[c].eqNullSafe(hot[h]) for c, h in zip(on, hot_cols)])


def split_hot(df: DataFrame, hot: HotKeys, on: Sequence[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """``(cold rows, hot rows)`` of ``df`` (``on`` names its key columns,
    default the hot key names).  The hot key set is broadcast."""
    assert hot.frame is not None
    on = list(on or hot.keys)
    names = [f"_hot_{i}" for i in range(len(hot.keys))]
    keys = F.broadcast(hot.frame.toDF(*names))
    cond = matches_hot(df, keys, on, names)
    return df.join(keys, cond, "left_anti"), df.join(keys, cond, "left_semi")
