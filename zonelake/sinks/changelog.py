"""Keyed-table semantics over a change log, as pure DataFrame functions.

A keyed table is the sequence of its commits.  Each commit is a batch of rows
tagged with the commit number (``_commit``, strictly increasing per table)
and a delete flag (``_deleted``).  The table as of commit ``t`` is, per
record key, the winning row among the commits ``<= t``, unless that row is a
delete.  Which row wins: of the later commit, and inside one commit the larger
ordering value (``order="commit"``, the precombine rule); or of the larger ordering
value among the rows since the key's last delete, whatever their commits
(``order="event"``).  A replace commit hides every earlier commit.

These functions only compute; ``sinks.zone`` stores one directory per commit
and hands over only the commits a read needs.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonelake.operators.dedup import keep_latest
from zonelake.operators.projection import as_list

COMMIT = "_commit"
DELETED = "_deleted"
META = [COMMIT, DELETED]


def tombstones(keys_df: DataFrame, commit: int) -> DataFrame:
    """Delete markers for the keys in ``keys_df`` (its other columns are ignored)."""
    return keys_df.withColumn(COMMIT, F.lit(commit).cast("long")).withColumn(DELETED, F.lit(True))


def _winners(log: DataFrame, keys: list[str], order_by: list[str], order: str) -> DataFrame:
    """The winning row of each key, deletes included."""
    data = [c for c in log.columns if c not in META]
    log = log.select(*data, *META)
    if order == "commit":
        return keep_latest(log, keys, [COMMIT, *order_by])
    if order != "event":
        raise ValueError(f"order must be 'commit' or 'event', not {order!r}")
    # one row per key, combined map-side; a delete's ordering value is null, so it wins only where nothing follows it
    gone = log.groupBy(*[F.col(k).alias(f"_{i}") for i, k in enumerate(keys)]).agg(F.max(F.when(F.col(DELETED), F.col(COMMIT))).alias("_gone"))
    gone = gone.where(F.col("_gone").isNotNull())
    same = [log[k].eqNullSafe(gone[f"_{i}"]) for i, k in enumerate(keys)]
    since = log.join(gone, same, "left").where(F.col("_gone").isNull() | (F.col(COMMIT) >= F.col("_gone"))).select(*data, *META)
    return keep_latest(since, keys, [*order_by, COMMIT])


def snapshot(
    log: DataFrame,
    keys: str | Sequence[str],
    order_by: str | Sequence[str],
    *,
    as_of: int | None = None,
    order: str = "commit",
) -> DataFrame:
    """The table at commit ``as_of`` (default: latest); data columns only."""
    if as_of is not None:
        log = log.where(F.col(COMMIT) <= F.lit(as_of))
    latest = _winners(log, as_list(keys), as_list(order_by), order)
    return latest.where(~F.col(DELETED)).drop(*META)


def changes_since(
    log: DataFrame,
    keys: str | Sequence[str],
    order_by: str | Sequence[str],
    commit: int,
    *,
    order: str = "commit",
) -> DataFrame:
    """Latest version of every key written after ``commit`` (incremental read),
    with the commit that wrote it and whether it is a delete."""
    late = F.col(COMMIT) > F.lit(commit)
    if order == "commit":
        return _winners(log.where(late), as_list(keys), as_list(order_by), order)
    # by event a late record may lose against an earlier commit; then nothing changed
    return _winners(log, as_list(keys), as_list(order_by), order).where(late)


def missing_keys(old: DataFrame, new: DataFrame, keys: str | Sequence[str], commit: int) -> DataFrame:
    """Delete markers of ``commit`` for the keys of ``old`` that ``new`` does not hold."""
    keys = as_list(keys)
    return tombstones(old.select(*keys).join(new.select(*keys), keys, "left_anti"), commit)
