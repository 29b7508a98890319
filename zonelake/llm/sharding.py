"""Longest-processing-time sharding of documents, groups of equal texts kept together.

LPT needs the groups in descending size and a heap of shard loads.  The groups stay on the cluster; the
driver sees them as size classes only (the leading 13 bits of the size: exact below 8192, within 1/4096
above), at most 220,000 of them at any corpus size.  The heap deals each class, largest first, and gives
back how many groups of the class go to each shard; a group finds its shard by its rank in the class.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize, shuffle_partitions

#: leading bits of a size that make its class
CLASS_BITS = 13


def lpt_counts(classes: list[tuple[float, int]], shards: int) -> list[list[int]]:
    """Groups per shard of each class (mean size, groups), classes in descending size.

    The least-loaded shard takes the next group; runs of groups that one shard (or every shard in turn)
    would take are dealt at once, so the work does not grow with the number of groups.
    """
    heap = [(0.0, s) for s in range(shards)]
    base, out = 0.0, []
    for size, left in classes:
        counts = [0] * shards
        while left:
            if left >= shards and max(heap)[0] - heap[0][0] <= size:
                each = left // shards
                counts = [c + each for c in counts]
                base, left = base + each * size, left - each * shards
                continue
            load, s = heapq.heappop(heap)
            room = heap[0][0] - load if heap else math.inf
            n = left if room == math.inf else min(left, max(1, math.ceil(room / size)))
            counts[s] += n
            left -= n
            heapq.heappush(heap, (load + n * size, s))
        out.append(counts)
    return out


def shard_documents(docs: DataFrame, shards: int = 8, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Deal all documents into shards of near-equal bytes: (id, size, text_crc32, law, shard, slot, grown_shard).

    Size: UTF-8 bytes of the text plus 1; a null text counts as an empty one (they are one group).  Documents with
    equal texts (SHA-256) share a shard.  ``slot`` numbers the rows of a shard from 0 without gaps, in no
    promised order.  Repeated rows and null ids are rows like others; an empty table gives an empty
    result; other columns are ignored.  ``grown_shard`` is null: the law is ``bytes``, not ``key``.
    """
    spark, text = docs.sparkSession, F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    sized = materialize(
        docs.select(
            F.col(id_col).alias("id"),
            (F.octet_length(text) + 1).cast("long").alias("size"),
            F.crc32(text).alias("crc"),
            F.unhex(F.sha2(text, 256)).alias("key"),
        )
    )
    drop = f"greatest(length(bin(bytes)) - {CLASS_BITS}, 0)"
    groups = materialize(
        sized.groupBy("key")
        .agg(F.sum("size").alias("bytes"))
        .withColumn("class", F.expr(f"shiftleft(shiftright(bytes, {drop}), {drop})"))
        .repartitionByRange(shuffle_partitions(spark), F.desc("class"), "key")
        .sortWithinPartitions(F.desc("class"), "key")
        .withColumn("at", F.monotonically_increasing_id())
        .withColumn("part", F.shiftright("at", 33))
    )
    # range partitions: a class spans neighbouring partitions, so there are at most classes + partitions cells
    cells = (
        groups.groupBy("class", "part")
        .agg(F.count(F.lit(1)).alias("n"), F.sum("bytes").alias("bytes"), F.min("at").alias("first"))
        .collect()
    )
    cells.sort(key=lambda c: (-c["class"], c["part"]))
    totals: dict[int, list] = {}
    ranks = []
    for c in cells:
        t = totals.setdefault(c["class"], [0, 0])
        ranks.append(t[0])
        t[0], t[1] = t[0] + c["n"], t[1] + c["bytes"]
    dealt = lpt_counts([(b / n, n) for n, b in totals.values()], shards)
    ends = {k: [sum(d[: s + 1]) for s in range(shards)] for k, d in zip(totals, dealt)}
    plan = spark.createDataFrame(
        [(c["class"], c["part"], c["first"] - r, ends[c["class"]]) for c, r in zip(cells, ranks)],
        "class long, part long, zero long, ends array<long>",
    )
    placed = groups.join(F.broadcast(plan), ["class", "part"]).select(
        "key", F.expr("size(filter(ends, e -> e <= at - zero))").alias("shard")
    )
    # both sides are plain shuffles, so AQE splits the partition of a text with very many copies
    dealt_rows = materialize(
        sized.join(placed, "key").select("id", "size", "crc", "shard", F.monotonically_increasing_id().alias("at"))
    ).withColumn("part", F.shiftright("at", 33))
    offset, starts = [0] * shards, {}
    for r in sorted(dealt_rows.groupBy("part", "shard").count().collect()):  # shards x partitions rows
        starts.setdefault(r["part"], [0] * shards)[r["shard"]] = offset[r["shard"]]
        offset[r["shard"]] += r["count"]
    given = spark.sparkContext.broadcast(starts)

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Slots in the order of the stored rows: a partition's rows of a shard follow those of earlier partitions."""
        free: dict[int, np.ndarray] = {}
        for batch in batches:
            part, shard = (batch.column(c).to_numpy() for c in ("part", "shard"))
            slot = np.zeros(len(batch), np.int64)
            for p in np.unique(part).tolist():
                here = np.flatnonzero(part == p)
                order = np.argsort(shard[here], kind="stable")
                dealt = shard[here][order]
                next_ = free.setdefault(p, np.array(given.value[p], np.int64))
                slot[here[order]] = next_[dealt] + np.arange(len(dealt)) - np.searchsorted(dealt, dealt)
                next_ += np.bincount(dealt, minlength=shards)
            yield batch.select(["id", "size", "crc", "shard"]).append_column("slot", pa.array(slot))

    kind = docs.schema[id_col].dataType.simpleString()
    return (
        dealt_rows.select("id", "size", "crc", "shard", "part")
        .mapInArrow(number, f"id {kind}, size long, crc long, shard int, slot long")
        .select(
            F.col("id").alias(id_col),
            "size",
            F.col("crc").alias("text_crc32"),
            F.lit("bytes").alias("law"),
            "shard",
            "slot",
            F.lit(None).cast("int").alias("grown_shard"),
        )
    )
