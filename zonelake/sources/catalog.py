"""Zones as catalog databases, reads of refined tables and table statistics."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Zones:
    """Database names of the three zones: ``<prefix>_landing`` and so on."""

    prefix: str = "lake"

    def database(self, zone: str) -> str:
        if zone not in ("landing", "trusted", "curated"):
            raise ValueError(f"unknown zone {zone!r}")
        return f"{self.prefix}_{zone}"

    def create(self, spark: SparkSession) -> None:
        for zone in ("landing", "trusted", "curated"):
            spark.sql(f"CREATE DATABASE IF NOT EXISTS `{self.database(zone)}`")


DEFAULT_ZONES = Zones()


def read_zone(spark: SparkSession, zone: str, table: str, zones: Zones = DEFAULT_ZONES) -> DataFrame:
    """A refined table by zone and name.  A missing table raises
    ``RuntimeError`` naming ``database.table`` at call time."""
    name = f"{zones.database(zone)}.{table}"
    try:
        df = spark.table(name)
        df.schema  # noqa: B018 - resolve now
    except Exception as exc:  # noqa: BLE001
        raise RuntimeError(f"failed to read table {name}: {exc}") from exc
    return df


def analyze_table(spark: SparkSession, name: str) -> tuple[int, int]:
    """Store the size and the row count of a catalog table (``database.table``) as its statistics; (bytes, rows).

    The planner then sizes joins by what the table holds, and with ``spark.sql.cbo.enabled`` by its rows too.  Rows of Parquet files
    are counted from their footers.  A later write does not change the statistics: analyze again.
    """
    spark.sql(f"ANALYZE TABLE {name} COMPUTE STATISTICS")
    stored = spark.sql(f"DESCRIBE EXTENDED {name}").filter("col_name = 'Statistics'").first()
    found = re.match(r"(\d+) bytes(?:, (\d+) rows)?", stored["data_type"])
    return int(found[1]), int(found[2] or 0)


def file_statistics(table: DataFrame, name: str = "") -> DataFrame:
    """One row: table_name, records, objects (files that hold rows), size_bytes and mean_record_bytes of a table of files.

    Reads the files' metadata columns only (of Parquet files the footers); counted per file first, combined map-side.
    """
    per_file = table.groupBy(F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_size").alias("_size")).agg(F.count(F.lit(1)).alias("_rows"))
    return per_file.agg(
        F.coalesce(F.sum("_rows"), F.lit(0)).cast("long").alias("records"),
        F.count(F.lit(1)).alias("objects"),
        F.coalesce(F.sum("_size"), F.lit(0)).cast("long").alias("size_bytes"),
        F.try_divide(F.sum("_size"), F.sum("_rows")).alias("mean_record_bytes"),
    ).select(F.lit(name).alias("table_name"), "*")
