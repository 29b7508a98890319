"""Positions and prefix values within runs of equal keys, over rows sorted across partitions.

A run may span many partitions: every partition is scanned as a stream, and what its first run has before it comes from
the totals of earlier partitions (one row a partition), so no run is ever gathered in one task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize, shuffle_partitions

BASE = 0x9E3779B97F4A7C15
_WRAP = (1 << 64) - 1


def sorted_rows(df: DataFrame, *order) -> DataFrame:
    """``df`` sorted over range partitions and stored, with ``at`` (ascending with the order) and ``part``.  Rows of equal
    order are dealt by a number of their own, so equal rows spread over partitions."""
    by = [*order, F.col("_tie")]
    return materialize(
        df.withColumn("_tie", F.monotonically_increasing_id())
        .repartitionByRange(shuffle_partitions(df.sparkSession), *by)
        .sortWithinPartitions(*by)
        .drop("_tie")
        .withColumn("at", F.monotonically_increasing_id())
        .withColumn("part", F.shiftright("at", 33))
    )


def powers(n: np.ndarray) -> np.ndarray:
    """BASE ** n modulo 2^64."""
    out, base, n = np.ones(len(n), np.uint64), BASE, n.copy()
    while n.any():
        odd = (n & 1).astype(bool)
        out[odd] *= np.uint64(base)
        base, n = base * base & _WRAP, n >> 1
    return out


def _scan(key: str, names: list[str], sums: list[str], carry: dict, after: dict):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, n0, held, part, waiting = None, 0, {c: 0 for c in names + sums}, None, None

        def ended(out: dict, next_key) -> pa.RecordBatch:
            flags = np.concatenate([out.pop("_new")[1:], [next_key is None or next_key != last]])
            return pa.RecordBatch.from_pydict(out | {"last": pa.array(flags)})

        for batch in batches:
            if not batch.num_rows:
                continue
            keys = batch.column(key)
            if part is None:
                part = batch.column("part")[0].as_py()
                before = carry.get(part)
                if before is not None:  # always of the partition's first run
                    last, n0, held = before["key"], before["n"], {c: before[c] for c in names + sums}
            if waiting is not None:
                yield ended(waiting, keys[0].as_py())
            new = np.ones(len(keys), dtype=bool)
            new[1:] = pc.not_equal(keys.slice(1), keys.slice(0, len(keys) - 1)).to_numpy(zero_copy_only=False)
            new[0] = keys[0].as_py() != last
            first = np.flatnonzero(new)
            goes_on = not new[0]
            begin = np.concatenate([[0], first]) if goes_on else first
            run_of = np.searchsorted(begin, np.arange(len(keys)), "right") - 1
            pos = np.arange(len(keys)) - begin[run_of]
            if goes_on:
                pos[run_of == 0] += n0
            out = {c: batch.column(c) for c in batch.schema.names}
            for c in names + sums:
                x = batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
                x = x * powers(pos) if c in names else x
                total = np.cumsum(x, dtype=np.uint64)
                value = total - np.concatenate([[np.uint64(0)], total])[begin][run_of]
                if goes_on:
                    value[run_of == 0] += np.uint64(held[c])
                out[c] = pa.array(value.view(np.int64))
                out[f"{c}_before"] = pa.array((value - x).view(np.int64))
                held[c] = int(value[-1])
            last, n0 = keys[-1].as_py(), int(pos[-1]) + 1
            waiting = out | {"pos": pa.array(pos.astype(np.int64)), "_new": new}
        if waiting is not None:
            yield ended(waiting, after.get(part))

    return run


def number_runs(rows: DataFrame, key: str, names: tuple[str, ...] = (), sums: tuple[str, ...] = ()) -> DataFrame:
    """``rows`` (of ``sorted_rows``) with ``pos``, the position from 0 in the run of ``key`` (not null), and ``last``, whether
    the run ends there.

    A column of ``sums`` (long) becomes its running sum within the run; one of ``names`` becomes the sum of its values times
    powers of BASE by position, modulo 2^64: random values (digests) thus give equal names to equal prefixes only.
    ``<column>_before`` is the value without the row's own.
    """
    cols, given = rows.columns, [*names, *sums]
    added = [f"{c}_before" for c in given] + ["pos", "last"]
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields] + [f"`{c}` {'boolean' if c == 'last' else 'long'}" for c in added])

    def scan(carry: dict, after: dict) -> DataFrame:
        return rows.mapInArrow(_scan(key, list(names), list(sums), carry, after), schema)

    ends = (
        scan({}, {})
        .groupBy("part")
        .agg(F.min_by(key, "at").alias("first"), F.max_by(F.struct(F.col(key).alias("key"), (F.col("pos") + 1).alias("n"), *given), "at").alias("end"))
        .collect()  # a row a partition
    )
    carry, after, state, before = {}, {}, None, None
    for e in sorted(ends, key=lambda e: e["part"]):
        end = e["end"].asDict()
        if before is not None:
            after[before] = e["first"]
        before = e["part"]
        if state is not None and state["key"] == e["first"]:
            carry[e["part"]] = state
            if end["key"] == e["first"]:  # one run only: it goes on
                factor = pow(BASE, state["n"], 1 << 64)
                for c in given:
                    end[c] = (state[c] + (end[c] * factor if c in names else end[c])) & _WRAP
                end["n"] += state["n"]
        state = end | {c: end[c] & _WRAP for c in given}
    return scan(carry, after).select(*cols, *added)
