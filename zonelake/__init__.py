"""zonelake: landing -> trusted -> curated refinement of sensor and customer
data on Spark, as DataFrame functions.

Entry points: ``plans.refine`` (the jobs), ``plans.jobs.refine_all`` (the
jobs through zone tables), ``sinks.zone.ZoneStore`` (keyed tables),
``sources.landing`` (landing reads) and ``session.configure``.
"""

from zonelake.operators.dedup import distinct_rows, keep_latest
from zonelake.operators.filters import consent_filter
from zonelake.operators.joins import customers_with_readings, device_readings_with_owner, fuse_on_time, gate
from zonelake.operators.numbering import number_rows
from zonelake.operators.projection import keep_columns, lower_columns
from zonelake.session import configure

__all__ = [
    "configure",
    "consent_filter",
    "customers_with_readings",
    "device_readings_with_owner",
    "distinct_rows",
    "fuse_on_time",
    "gate",
    "keep_columns",
    "keep_latest",
    "lower_columns",
    "number_rows",
]
