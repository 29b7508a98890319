"""The refinement run end to end through zone tables.

Each job reads its inputs from the zone it depends on and commits its output
as a table, so every step starts from stored data (a lost executor never
sends a later job back to the landing files) and the steps can run as
separate applications, as the original scripts did.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from zonelake.plans import checks, refine
from zonelake.session import at_once
from zonelake.sinks.zone import ZoneStore
from zonelake.sources.catalog import read_zone


def refine_all(
    spark: SparkSession,
    landing: Mapping[str, DataFrame],
    store: ZoneStore,
    *,
    same_user: bool = False,
    expected: Mapping[str, int] | None = None,
    analyze: bool = False,
) -> DataFrame:
    """Run the five jobs in dependency order; return the run report: ``(table_name, row_count, columns)``, the
    schema of each table as it was written.  The numbers of the numbered tables are verified before they count.  ``analyze``
    stores each table's statistics in the catalog before the next job plans its reads.  Counts other than ``expected`` are an error.

    ``landing`` holds the three landing feeds (``customer_landing``,
    ``accelerometer_landing``, ``step_trainer_landing``), read with
    ``sources.landing.read_landing`` or any other source.
    """
    keys = refine.TABLE_KEYS
    store.zones.create(spark)

    def commit(df: DataFrame, zone: str, table: str, unique: bool) -> DataFrame:
        key, order = keys[table]
        store.write(df, zone, table, key, order, unique=unique, numbered="rn" if "rn" in key else None)
        if analyze:
            store.analyze(spark, zone, table)
        return read_zone(spark, zone, table, store.zones)  # through the catalog, as the original jobs did

    customers = commit(refine.customer_trusted(landing["customer_landing"]), "trusted", "customer_trusted", True)
    at_most = refine.customer_size(customers)
    # the two sensor jobs need the customers only
    accel, steps = at_once(
        spark,
        lambda: commit(refine.accelerometer_trusted(landing["accelerometer_landing"], customers, at_most=at_most), "trusted", "accelerometer_trusted", True),
        lambda: commit(refine.step_trainer_trusted(landing["step_trainer_landing"], customers, at_most=at_most), "trusted", "step_trainer_trusted", True),
    )
    curated = commit(refine.customer_curated(accel, customers), "curated", "customer_curated", True)
    ml = commit(
        refine.ml_curated(steps, accel, customers, owners=curated, same_user=same_user), "curated", "machine_learning_curated", True
    )
    tables = {
        "customer_trusted": customers,
        "accelerometer_trusted": accel,
        "step_trainer_trusted": steps,
        "customer_curated": curated,
        "machine_learning_curated": ml,
    }
    return report(tables, expected)


def report(tables: Mapping[str, DataFrame], expected: Mapping[str, int] | None = None) -> DataFrame:
    """``(table_name, row_count, columns)``; counts other than ``expected`` are an error."""
    counts = checks.zone_counts(tables)
    if expected is not None:
        checks.assert_counts(counts, expected)
    columns = F.create_map(*[F.lit(x) for name, df in tables.items() for x in (name, df.schema.simpleString())])
    return counts.withColumn("columns", columns[F.col("table_name")])
