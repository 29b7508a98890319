"""Small column builders.  Everything here is a Catalyst expression, so it
stays inside whole-stage codegen; nothing runs in Python per row."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def epoch_millis(ts: str | Column) -> Column:
    """Milliseconds since 1970-01-01 of a wall-clock timestamp, read as UTC.

    Works on ``timestamp_ntz`` without consulting the session time zone
    (``timestampdiff`` on NTZ values is zone-free), so the result does not move
    when a job runs under another zone.
    """
    return F.timestamp_diff(
        "MILLISECOND",
        F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"),
        _col(ts).cast("timestamp_ntz"),
    )


def floor_to(value: str | Column, step: int) -> Column:
    """``value`` rounded down to a multiple of ``step`` (long arithmetic)."""
    v = _col(value).cast("long")
    return (F.floor(v / F.lit(step)) * F.lit(step)).cast("long")


def json_int(doc: str | Column, field: str) -> Column:
    """Integer field ``$.field`` of a JSON text column (null when absent)."""
    return F.get_json_object(_col(doc), f"$.{field}").cast("int")


def key_struct(cols: Sequence[str]) -> Column:
    """Struct of key columns; compared null-safely as one value."""
    return F.struct(*[F.col(c) for c in cols])


def zero_sign(c: str) -> Column:
    """Whether a float column holds the negative zero, which grouping and ordering take for the positive one."""
    return (F.col(c) == 0) & F.col(c).cast("string").startswith("-")


def float_columns(df: DataFrame, cols: Iterable[str] | None = None) -> list[str]:
    """The float and double columns among ``cols`` (default: all)."""
    kinds = dict(df.dtypes)
    return [c for c in (df.columns if cols is None else cols) if kinds[c] in ("float", "double")]


def group_keeping_zeros(df: DataFrame, keys: list[str], *aggregates: Column) -> DataFrame:
    """``groupBy(keys).agg(...)`` in which the two float zeros are different values and keep their sign."""
    floats = float_columns(df, keys)
    signs = [zero_sign(c).alias(f"_neg_{c}") for c in floats]
    out = df.groupBy(*keys, *signs).agg(*aggregates)
    kinds = dict(df.dtypes)
    for c in floats:
        out = out.withColumn(c, F.when(F.col(f"_neg_{c}"), F.lit(-0.0).cast(kinds[c])).otherwise(F.col(c)))
    return out.drop(*[f"_neg_{c}" for c in floats])


def total_order(df: DataFrame, cols: list[str]) -> list[Column]:
    """Ascending order on ``cols`` (nulls first) that also tells the two float zeros apart, the negative one first."""
    floats = set(float_columns(df, cols))
    order = []
    for c in cols:
        order.append(F.col(c).asc_nulls_first())
        if c in floats:
            order.append(zero_sign(c).desc())
    return order
