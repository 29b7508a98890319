"""Incremental landing ingest with Structured Streaming.

New JSON files arriving in a landing directory are picked up by the file
stream source; every micro-batch is refined by a batch function and
committed to a keyed zone table as an upsert that names the batch.  A micro-batch that is replayed after
a failure is found committed and skipped, so every batch is committed once.  Which of two records of a key wins is
told by the table's order (``event`` by default: a late record changes nothing).

Only jobs whose result per key depends on that key's rows alone can run this
way (the consenting-customer table); numbered tables depend on all earlier
rows of an entity and are rebuilt in batch.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from zonelake.sinks.zone import ZoneStore
from zonelake.sources.landing import typed_lines


def ingest_landing(
    spark: SparkSession,
    landing_path: str,
    schema: T.StructType,
    store: ZoneStore,
    zone: str,
    table: str,
    keys: str | Sequence[str],
    order_by: str | Sequence[str],
    checkpoint: str,
    *,
    refine: Callable[[DataFrame], DataFrame] = lambda df: df,
    available_now: bool = True,
    max_files_per_trigger: int | None = None,
    order: str = "event",
) -> StreamingQuery:
    """Start the stream; with ``available_now`` it processes what is there
    and stops (a scheduled incremental run), otherwise it keeps polling."""
    reader = spark.readStream
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    stream = typed_lines(reader.text(landing_path), schema)

    def commit(batch: DataFrame, batch_id: int) -> None:
        store.write(refine(batch), zone, table, keys, order_by, mode="upsert", order=order, batch=f"{checkpoint}#{batch_id}")

    writer = stream.writeStream.foreachBatch(commit).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()
