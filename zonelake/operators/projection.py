"""Projections: column-name normalisation and side selection."""

from __future__ import annotations

from collections import Counter
from collections.abc import Sequence

from pyspark.sql import DataFrame


def as_list(cols: str | Sequence[str] | None) -> list[str]:
    """Column names given as one name, several or none."""
    return [] if cols is None else [cols] if isinstance(cols, str) else list(cols)


def lower_columns(df: DataFrame) -> DataFrame:
    """Rename every column to lower case.

    ``toDF`` renames positionally, so names holding dots or other characters
    that ``col()`` would parse are safe.  Two columns that differ only in case
    would collapse into one name; that is refused instead of producing a frame
    with an ambiguous column.
    """
    lowered = [c.lower() for c in df.columns]
    clashes = sorted(n for n, k in Counter(lowered).items() if k > 1)
    if clashes:
        raise ValueError(f"columns collide when lower-cased: {clashes}")
    if lowered == df.columns:
        return df
    return df.toDF(*lowered)


def keep_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Project ``columns`` in the given order (pruned down to the scan)."""
    return df.select(*columns)
