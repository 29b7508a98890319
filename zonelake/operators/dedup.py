"""Deduplication: keep-latest per record key and whole-row distinct."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonelake.operators.projection import as_list


def keep_latest(df: DataFrame, keys: str | Sequence[str], order_by: str | Sequence[str]) -> DataFrame:
    """One row per record key: the one with the largest ``order_by`` value.

    This is what a keyed upsert writer does with a record key and a
    precombine field.  Ties on ``order_by`` are broken by the remaining
    columns (largest wins), so the surviving row is deterministic.

    Written as an aggregate, ``max(struct(order_by, rest))`` per key, rather
    than a ``row_number`` window: the aggregate is combined map-side before
    the shuffle, so a key holding a large share of the rows is reduced to one
    row per input task instead of being sorted whole in one task.  Null keys
    form one group of their own; struct ordering puts nulls first, so a row
    with a null ordering value only wins when no other row exists for its key.
    """
    keys = as_list(keys)
    order_by = as_list(order_by)
    missing = [c for c in keys + order_by if c not in df.columns]
    if missing:
        raise ValueError(f"unknown columns {missing}; frame has {df.columns}")
    rest = [c for c in df.columns if c not in keys and c not in order_by]
    packed = F.struct(*[F.col(c) for c in order_by + rest])
    latest = df.groupBy(*keys).agg(F.max(packed).alias("_latest"))
    return latest.select(
        *[F.col(c) if c in keys else F.col("_latest").getField(c).alias(c) for c in df.columns]
    )


def distinct_rows(df: DataFrame) -> DataFrame:
    """Whole-row distinct (hash aggregate with a map-side partial step, so
    repeated rows are merged before they are shuffled)."""
    return df.distinct()
