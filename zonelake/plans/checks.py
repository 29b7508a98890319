"""Checks on refined tables: row counts, consent, record keys, previews.

Each check is a DataFrame (so it runs distributed and can be written like any
table); the ``assert_*`` helpers collect its single small result row.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from zonelake.operators.joins import may_match
from zonelake.operators.projection import as_list
from zonelake.schemas import CONSENT_COLUMN

# Blocks with violations up to which the bitmap of ``_suspects`` (256 KB) sorts out nearly all other rows; with more, fewer.
SUSPECT_BLOCKS = 1 << 16
# Masks of 64 numbers in a row of the numbering check: the row's key is paid for once for all of them.
MASKS = 8


def union_all(frames: list[DataFrame], missing: bool = False) -> DataFrame:
    """Union by name; with ``missing`` a column that a frame lacks is null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=missing), frames)


def zone_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """``(table_name, row_count)`` for each table."""
    return union_all(
        [df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
         for name, df in tables.items()]
    )


def assert_counts(counts: DataFrame, expected: Mapping[str, int]) -> None:
    """Raise when a table's count differs from ``expected`` (one small collect)."""
    got = {r["table_name"]: r["row_count"] for r in counts.collect()}
    bad = {t: (got.get(t), n) for t, n in expected.items() if got.get(t) != n}
    if bad:
        raise AssertionError(f"row counts differ (got, expected): {bad}")


def consent_violations(customers: DataFrame, column: str = CONSENT_COLUMN) -> DataFrame:
    """``(checked_rows, missing_consent)``: a trusted customer table must have
    a consent date on every row."""
    return customers.agg(
        F.count(F.lit(1)).alias("checked_rows"),
        F.count(F.when(F.col(column).isNull(), 1)).alias("missing_consent"),
    )


def key_violations(df: DataFrame, keys: str | Sequence[str], table_name: str = "") -> DataFrame:
    """``(table_name, null_keys, duplicate_keys)``: rows with a null key part,
    and keys held by more than one row.  Counted per key with an aggregate
    combined map-side, of the rows that ``_suspects`` leaves."""
    keys = as_list(keys)
    per_key = _suspects(df.select(*keys), keys).groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    any_null = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    return per_key.agg(
        F.coalesce(F.sum(F.when(any_null, F.col("_n"))), F.lit(0)).cast("long").alias("null_keys"),
        F.count(F.when(~any_null & (F.col("_n") > 1), 1)).alias("duplicate_keys"),
    ).select(F.lit(table_name).alias("table_name"), "null_keys", "duplicate_keys")


def _suspects(df: DataFrame, keys: list[str]) -> DataFrame:
    """The key rows without those that cannot violate: a superset of the rows with a null key part or a repeated key.

    Where the last key is an integer (a number, a device), the keys of 64 neighbouring values of it fall into one hash block with
    their count and a mask of those seen.  A block with as many rows as bits holds each key once; the rows of the others
    are found by a broadcast bitmap of fixed size and stay.  Where all is well none stay, and no count per key is held or moved.
    """
    last = F.col(keys[-1]).cast("long")
    if df.schema[keys[-1]].dataType not in (T.LongType(), T.IntegerType(), T.ShortType(), T.ByteType()):
        return df
    named = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    rows = df.withColumn("_block", F.xxhash64(*keys[:-1], F.shiftright(last, 6)))
    bit = F.when(named, F.call_function("shiftleft", F.lit(1).cast("long"), last.bitwiseAND(63).cast("int")))
    blocks = rows.groupBy("_block").agg(F.count(F.lit(1)).alias("_n"), F.coalesce(F.bit_count(F.bit_or(bit)), F.lit(0)).alias("_d"))
    return may_match(rows, "_block", blocks.where(F.col("_n") > F.col("_d")), "_block", SUSPECT_BLOCKS).select(*keys)


def numbering_violations(df: DataFrame, key: str, number: str = "rn", table_name: str = "") -> DataFrame:
    """``(table_name, null_keys, repeated, missing)``: rows with a null key or number, numbers that a key holds again, and numbers
    between 1 and a key's largest that it lacks.

    Exact, at a fraction of the shuffle of a count per (key, number): 64 * MASKS neighbouring numbers of a key are one row, their
    count and masks of those seen, combined map-side.  A table whose check is (0, 0, 0) holds every (key, number) once.
    """
    named = F.col(key).isNotNull() & (F.col(number) >= 1)
    bit, mask = F.expr(f"shiftleft(1L, cast(`{number}` % 64 AS INT))"), F.expr(f"(`{number}` div 64) % {MASKS}")
    masks = [F.bit_or(F.when(named & (mask == i), bit)) for i in range(MASKS)]
    seen = reduce(lambda a, b: a + b, [F.coalesce(F.bit_count(m), F.lit(0)).cast("long") for m in masks])
    blocks = df.groupBy(F.col(key).alias("_k"), F.expr(f"`{number}` div {64 * MASKS}").alias("_b"), F.coalesce(named, F.lit(False)).alias("_ok")).agg(
        F.count(F.lit(1)).alias("_n"), seen.alias("_d"), F.max(number).alias("_last")
    )
    keys = blocks.groupBy("_k", "_ok").agg(F.sum("_n").alias("_n"), F.sum("_d").alias("_d"), F.max("_last").alias("_last"))
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("long")
    return keys.agg(
        total(F.when(~F.col("_ok"), F.col("_n"))).alias("null_keys"),
        total(F.when(F.col("_ok"), F.col("_n") - F.col("_d"))).alias("repeated"),
        total(F.when(F.col("_ok"), F.col("_last") - F.col("_d"))).alias("missing"),
    ).select(F.lit(table_name).alias("table_name"), "null_keys", "repeated", "missing")


def assert_numbering(df: DataFrame, key: str, number: str = "rn") -> None:
    """Raise unless every key's rows are numbered 1, 2, ... without a repetition or a gap."""
    row = numbering_violations(df, key, number).first()
    if any(row[c] for c in ("null_keys", "repeated", "missing")):
        raise ValueError(f"numbers {number} of {key}: {row['null_keys']} rows without key or number, {row['repeated']} duplicated, {row['missing']} missing")


def count_check(tables: Mapping[str, DataFrame], expected: DataFrame) -> DataFrame:
    """``(table_name, row_count, expected, ok)``: the counts of ``tables`` against ``expected`` (table_name, expected)."""
    found = zone_counts(tables).join(expected, "table_name", "full")
    return found.select("table_name", "row_count", "expected", F.col("row_count").eqNullSafe(F.col("expected")).alias("ok"))


def assert_key(df: DataFrame, keys: str | Sequence[str]) -> None:
    """Raise when a record key part is null or a key is not unique."""
    row = key_violations(df, keys).first()
    if row["null_keys"] or row["duplicate_keys"]:
        raise ValueError(
            f"record key {list(as_list(keys))}: {row['null_keys']} rows with null key, "
            f"{row['duplicate_keys']} duplicated keys"
        )


def preview(df: DataFrame, order: str | Sequence[str], n: int = 10) -> DataFrame:
    """The first ``n`` rows in ``order`` (a top-n: each task keeps n rows)."""
    return df.orderBy(*as_list(order)).limit(n)


def schema_report(tables: Mapping[str, DataFrame]) -> DataFrame:
    """``(table_name, position, column_name, data_type, nullable)`` for each
    table: the schemas the jobs write, as a table (built from the plans'
    metadata; no data is read)."""
    spark = next(iter(tables.values())).sparkSession
    entries = [
        (name, i, f.name, f.dataType.simpleString(), f.nullable)
        for name, df in tables.items()
        for i, f in enumerate(df.schema.fields, start=1)
    ]
    return spark.createDataFrame(
        entries, "table_name string, position int, column_name string, data_type string, nullable boolean"
    )
