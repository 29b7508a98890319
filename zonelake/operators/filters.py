"""Row filters."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonelake.schemas import CONSENT_COLUMN


def consent_filter(df: DataFrame, column: str = CONSENT_COLUMN) -> DataFrame:
    """Keep the rows whose consent date is present.

    Only presence counts: any value (also 0 or a future date) passes, an
    absent JSON key or a null does not.  The predicate is a plain
    ``IsNotNull`` and is pushed into the file scan.
    """
    return df.filter(F.col(column).isNotNull())
