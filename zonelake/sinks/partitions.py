"""Partitioned tables without a history: a write replaces the partitions that its rows belong to and no others.

The write is Spark's dynamic partition overwrite: rows are staged beside the table and each partition of the batch is swapped
when all of them are written, so a task that is run again after a lost executor leaves nothing twice.  A batch is put
together per partition value before it is written (one shuffle), so a partition holds few files; a value with
very many rows is split over tasks by the adaptive rebalance.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from zonelake.operators.dedup import keep_latest
from zonelake.operators.projection import as_list, lower_columns


def replace_partitions(
    df: DataFrame, path: str, partition_by: str | Sequence[str], keys: str | Sequence[str], order_by: str | Sequence[str], *, name: str | None = None
) -> None:
    """Write ``df`` (one row per record key and partition, the largest ``order_by``) to the table at ``path``.

    Partitions that the batch has no row of stay as they are; an empty batch changes nothing.  A batch that reads the table
    itself must be stored first.  Null partition values are a partition of their own.  With ``name``
    (``database.table``) the catalog entry is made anew, so partitions that are new to the table are in it.
    """
    parts = as_list(partition_by)
    keys = [*as_list(keys), *(p for p in parts if p not in as_list(keys))]
    rows = keep_latest(lower_columns(df), keys, order_by)
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in rows.schema.fields])
    rows.hint("rebalance", *[F.col(p) for p in parts]).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*parts).parquet(path)
    if name:
        spark, fields = df.sparkSession, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
        spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name.split('.')[0]}`")
        spark.sql(f"DROP TABLE IF EXISTS {name}")
        spark.sql(f"CREATE TABLE {name} ({fields}) USING parquet PARTITIONED BY ({', '.join(f'`{p}`' for p in parts)}) LOCATION '{path}'")
        spark.sql(f"ALTER TABLE {name} RECOVER PARTITIONS")


def read_partitions(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The table with the declared types (partition values keep theirs, also where they look like numbers)."""
    return spark.read.schema(schema).parquet(path).select(schema.fieldNames())
