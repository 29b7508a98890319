"""Keyed zone tables as plain Parquet logs: replace / upsert / delete, catalog entries and table functions.

A table at ``<root>/<zone>/<table>`` is two Parquet tables that Spark writes and reads::

    rows/_commit=<n>/...   the rows of commit n with ``_deleted``, partitioned by ``_commit`` (then by ``partition_by``)
    commits/...            one row per finished commit: what it is, the table's keys, order and columns since the last replace

A commit's rows are written (and checked) first and count once its row is in ``commits``; a number that was not finished is
written anew, whatever it left.  ``replace`` begins a new schema; an ``upsert`` may add columns and widen types (``WIDER``); narrower
values are stored in the wider type, earlier files are read in it.  The current table, a past commit and the changes
after a commit are ``changelog`` functions over a range of ``_commit``, which prunes the partitions of all other commits.

Catalog: ``<db>.<table>__rows`` is the external table over ``rows``, ``<table>__log`` the view of the commits since the last replace,
``<table>`` the current table; ``<db>__<table>__as_of(n)`` and ``<db>__<table>__changes(n)`` are table functions of the session
over the log, from its second commit on.  One writer per table.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import asdict, dataclass, replace
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from zonelake.operators.dedup import keep_latest
from zonelake.operators.projection import as_list, lower_columns
from zonelake.plans.checks import assert_key, assert_numbering
from zonelake.sinks.changelog import COMMIT, DELETED, META, changes_since, missing_keys, snapshot
from zonelake.sources.catalog import DEFAULT_ZONES, Zones, analyze_table

COMMITS_SCHEMA = (
    "commit long, kind string, keys array<string>, order_by array<string>, partition_by array<string>, order string, columns string, batch string, rows long"
)
#: Pages are compressed each on its own.  They are cut by bytes, not every 20,000 rows (Parquet's default), so that what comes again and again
#: (the tuples of an instant, for each of its devices) is paid for once in many more rows.
ENCODING = {"parquet.writer.version": "PARQUET_2_0", "compression": "zstd", "parquet.page.size": 4 << 20, "parquet.page.row.count.limit": 1 << 20}
#: type -> the wider one that keeps all its values
WIDER = {"smallint": "int", "int": "bigint", "float": "double"}


@dataclass(frozen=True)
class Commit:
    commit: int
    kind: str
    keys: list[str]
    order_by: list[str]
    partition_by: list[str]
    order: str = "commit"
    columns: str = ""  # the table's columns after this commit, as JSON
    batch: str | None = None  # name of the source batch, if it came from a stream
    rows: int = 0  # as they were counted while they were written

    @property
    def schema(self) -> T.StructType:
        return T.StructType.fromJson(json.loads(self.columns))


def _wide(name: str) -> list[str]:
    """The types that ``name`` widens to, itself first."""
    out = [name]
    while out[-1] in WIDER:
        out.append(WIDER[out[-1]])
    return out


def merge_columns(known: T.StructType | None, new: T.StructType) -> T.StructType:
    """``known`` with the added columns of ``new``, each in the wider of its two types; other changes of type are refused."""
    out = {f.name: f.dataType for f in known.fields} if known else {}
    for f in new.fields:
        old = out.setdefault(f.name, f.dataType)
        a, b = old.simpleString(), f.dataType.simpleString()
        if b not in _wide(a) and a not in _wide(b):
            raise ValueError(f"column {f.name} is {a}, not {b}; replace the table")
        out[f.name] = f.dataType if b in _wide(a) else old
    return T.StructType([T.StructField(c, t) for c, t in out.items()])


@dataclass(frozen=True)
class ZoneStore:
    """Where zone tables live (a shared file system or object store URI)
    and which catalog databases name them."""

    root: str
    zones: Zones = DEFAULT_ZONES

    def path(self, zone: str, table: str) -> str:
        self.zones.database(zone)
        return f"{self.root.rstrip('/')}/{zone}/{table}"

    def commits(self, spark: SparkSession, zone: str, table: str) -> list[Commit]:
        """Finished commits in order (a row each).  A table without the folder has none; any other failure is raised."""
        try:
            rows = spark.read.schema(COMMITS_SCHEMA).parquet(f"{self.path(zone, table)}/commits").collect()
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return []
        return sorted((Commit(**r.asDict()) for r in rows), key=lambda c: c.commit)

    def _done(self, spark: SparkSession, zone: str, table: str, as_of: int | None = None) -> list[Commit]:
        done = [c for c in self.commits(spark, zone, table) if as_of is None or c.commit <= as_of]
        if not done:
            raise RuntimeError(f"table {zone}.{table} has no commit{f' up to {as_of}' if as_of is not None else ''} at {self.path(zone, table)}")
        return done

    # ------------------------------------------------------------------ reads

    def _rows(self, spark: SparkSession, zone: str, table: str, head: Commit, first: int, last: int) -> DataFrame:
        """Rows of the commits first..last in the columns that ``head`` states; other commits' partitions are pruned."""
        rows = spark.read.schema(head.schema.add(COMMIT, T.LongType())).parquet(f"{self.path(zone, table)}/rows")
        data = [f.name for f in head.schema.fields if f.name != DELETED]
        return rows.where(F.col(COMMIT).between(first, last)).select(*data, *META)

    def log(self, spark: SparkSession, zone: str, table: str, *, as_of: int | None = None) -> DataFrame:
        """Rows of all commits since the last replace (up to ``as_of``) with ``_commit`` and ``_deleted``; a column that a commit
        lacks is null in its rows."""
        live = _since_replace(self._done(spark, zone, table, as_of))
        return self._rows(spark, zone, table, live[-1], live[0].commit, live[-1].commit)

    def read(self, spark: SparkSession, zone: str, table: str, *, as_of: int | None = None) -> DataFrame:
        """The table as of commit ``as_of`` (default: the latest)."""
        head, log = self._done(spark, zone, table, as_of)[-1], self.log(spark, zone, table, as_of=as_of)
        return log.drop(*META) if head.kind == "replace" else snapshot(log, head.keys, head.order_by, order=head.order)

    def changes(self, spark: SparkSession, zone: str, table: str, since: int) -> DataFrame:
        """Latest version of every key written after commit ``since``, with ``_commit`` and ``_deleted``
        (incremental read).  Keys that a replace left out are reported as deleted by it."""
        done = self._done(spark, zone, table)
        head, live = done[-1], _since_replace(done)
        replaced = live[0].kind == "replace" and live[0].commit > since
        first = live[0].commit if replaced or head.order == "event" else max(live[0].commit, since + 1)
        found = changes_since(self._rows(spark, zone, table, head, first, head.commit), head.keys, head.order_by, since, order=head.order)
        if not replaced or done[0].commit > since:
            return found
        gone = missing_keys(self.read(spark, zone, table, as_of=since), found, head.keys, live[0].commit)
        return found.unionByName(gone, allowMissingColumns=True)

    # ----------------------------------------------------------------- writes

    def write(
        self,
        df: DataFrame,
        zone: str,
        table: str,
        keys: str | Sequence[str],
        order_by: str | Sequence[str],
        *,
        mode: str = "replace",
        order: str = "commit",
        unique: bool = False,
        partition_by: str | Sequence[str] | None = None,
        validate: bool = True,
        check_unique: bool = False,
        numbered: str | None = None,
        batch: str | None = None,
    ) -> int:
        """Commit ``df`` to the table and refresh its catalog entries; returns the commit number.

        Column names are lower-cased.  Rows are reduced to one per record key (largest ``order_by``) unless
        ``unique=True`` says the key is unique by construction (a ``(key, rn)`` pair), which saves a shuffle.
        ``order`` says which row of a key wins over upserts: of the later commit (``commit``) or of the larger
        ``order_by`` value, whatever the commit (``event``; late records then change nothing).  Rows and null keys are
        counted while they are written, before the commit counts: with ``validate`` a null key part (refused by keyed
        writers) fails the write.  ``check_unique`` also verifies a key claimed unique (one more shuffle of the written rows);
        it reads the written files, not the job's lineage.  ``numbered`` names the number column of a key ``(k, number)``: the written rows
        of each k must be numbered 1, 2, ... (at best one row for 512 of them is shuffled).  ``partition_by`` is the table's from its first commit on.  ``batch``
        names a source batch: one that is already committed is not committed again.
        """
        if mode not in ("replace", "upsert"):
            raise ValueError(f"mode must be 'replace' or 'upsert', not {mode!r}")
        if order not in ("commit", "event"):
            raise ValueError(f"order must be 'commit' or 'event', not {order!r}")
        spark, keys, order_by, parts = df.sparkSession, as_list(keys), as_list(order_by), as_list(partition_by)
        done = self.commits(spark, zone, table)
        for c in done:
            if batch is not None and c.batch == batch:
                return c.commit
        if done and parts != done[-1].partition_by and (partition_by is not None or mode == "replace"):
            raise ValueError(f"{zone}.{table} is partitioned by {done[-1].partition_by}, not {parts}")
        parts = done[-1].partition_by if done else parts
        df = lower_columns(df)
        rows = (df if unique else keep_latest(df, keys, order_by)).withColumn(DELETED, F.lit(False))
        try:
            columns = merge_columns(done[-1].schema if done and mode == "upsert" else None, rows.schema)
        except ValueError as e:
            raise ValueError(f"{zone}.{table}: {e}") from None
        new, nulls = self._put(rows, zone, table, Commit(done[-1].commit + 1 if done else 1, mode, keys, order_by, parts, order, columns.json(), batch), numbered)
        if validate:
            written = self._rows(spark, zone, table, new, new.commit, new.commit)
            if nulls:
                raise ValueError(f"{zone}.{table}: {nulls} rows with a null record key {keys}")
            if unique and check_unique:
                assert_key(written, keys)
            if numbered:
                assert_numbering(written, next(k for k in keys if k != numbered), numbered)
        return self._finish(spark, zone, table, [*done, new])

    def delete(self, keys_df: DataFrame, zone: str, table: str) -> int:
        """Commit tombstones for the record keys in ``keys_df``."""
        spark, done = keys_df.sparkSession, self._done(keys_df.sparkSession, zone, table)
        head = done[-1]
        marks = lower_columns(keys_df).select(*head.keys).distinct().withColumn(DELETED, F.lit(True))
        new, _ = self._put(marks, zone, table, Commit(head.commit + 1, "delete", head.keys, head.order_by, head.partition_by, head.order, head.columns))
        return self._finish(spark, zone, table, [*done, new])

    def _put(self, rows: DataFrame, zone: str, table: str, new: Commit, numbered: str | None = None) -> tuple[Commit, int]:
        """Write the rows of a commit, in the table's types; replaces what an unfinished attempt at this number left.  The commit with
        its number of rows, and how many of them have a null key part.  The numbers of ``numbered`` are stored as differences; with a
        dictionary, which many short keys would fill but not overflow, each takes the bits of the largest."""
        types = {f.name: f.dataType for f in new.schema.fields}
        rows = rows.select(*[F.col(f"`{c}`").cast(types[c]).alias(c) for c in rows.columns], *[F.lit(None).cast(types[p]).alias(p) for p in new.partition_by if p not in rows.columns])
        seen, null = Observation(), reduce(lambda a, b: a | b, [F.col(k).isNull() for k in new.keys])
        writer = rows.observe(seen, F.count(F.lit(1)).alias("rows"), F.count_if(null).alias("nulls")).write.mode("overwrite").options(**ENCODING)
        writer = writer.option(f"parquet.enable.dictionary#{numbered}", "false") if numbered else writer
        (writer.partitionBy(*new.partition_by) if new.partition_by else writer).parquet(f"{self.path(zone, table)}/rows/{COMMIT}={new.commit}")
        return replace(new, rows=int(seen.get["rows"])), int(seen.get["nulls"])

    def analyze(self, spark: SparkSession, zone: str, table: str) -> tuple[int, int]:
        """Statistics of the table's rows (of all commits) for the planner: (bytes, rows)."""
        return analyze_table(spark, f"`{self.zones.database(zone)}`.`{table}__rows`")

    def register(self, spark: SparkSession, zone: str, table: str) -> None:
        """Make the catalog entries and the session's table functions of a table that another application wrote."""
        register(spark, self.zones.database(zone), table, f"{self.path(zone, table)}/rows", _since_replace(self._done(spark, zone, table)))

    def _finish(self, spark: SparkSession, zone: str, table: str, done: list[Commit]) -> int:
        record = spark.createDataFrame([tuple(asdict(done[-1]).values())], COMMITS_SCHEMA)
        record.coalesce(1).write.mode("append").parquet(f"{self.path(zone, table)}/commits")
        register(spark, self.zones.database(zone), table, f"{self.path(zone, table)}/rows", _since_replace(done))
        return done[-1].commit


def _since_replace(done: list[Commit]) -> list[Commit]:
    """The commits from the last replace on (all, if there is none)."""
    at = max((i for i, c in enumerate(done) if c.kind == "replace"), default=0)
    return done[at:]


def register(spark: SparkSession, db: str, table: str, path: str, live: list[Commit]) -> None:
    """(Re)create the catalog entries of a log: its rows, the views and the table functions."""
    head, name = live[-1], f"`{db}`.`{table}"  # the closing quote follows
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in head.schema.fields]
    data = [f.name for f in head.schema.fields if f.name != DELETED]
    quoted = lambda names: ", ".join(f"`{c}`" for c in names)
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{db}`")
    spark.sql(f"DROP TABLE IF EXISTS {name}__rows`")
    spark.sql(f"CREATE TABLE {name}__rows` ({', '.join(fields)}, {COMMIT} BIGINT) USING parquet PARTITIONED BY ({quoted([COMMIT, *head.partition_by])}) LOCATION '{path}'")
    spark.sql(f"ALTER TABLE {name}__rows` RECOVER PARTITIONS")
    spark.sql(f"CREATE OR REPLACE VIEW {name}__log` AS SELECT {quoted([*data, *META])} FROM {name}__rows` WHERE {COMMIT} BETWEEN {live[0].commit} AND {head.commit}")
    keys = quoted(head.keys)
    order = [COMMIT, *head.order_by] if head.order == "commit" else [*head.order_by, COMMIT]
    packed = quoted([*order, *(c for c in [*data, *META] if c not in head.keys and c not in order)])
    picks = ", ".join(f"`{c}`" if c in head.keys else f"_latest.`{c}` AS `{c}`" for c in data)

    def winners(commits: str) -> str:
        source = f"(SELECT * FROM {name}__log` WHERE {commits})"
        if head.order == "event":  # since the key's last delete
            source = f"(SELECT *, max(CASE WHEN {DELETED} THEN {COMMIT} END) OVER (PARTITION BY {keys}) AS _gone FROM {source}) WHERE {COMMIT} >= coalesce(_gone, 0)"
        return f"(SELECT {keys}, max(struct({packed})) AS _latest FROM {source} GROUP BY {keys})"

    spark.sql(
        f"CREATE OR REPLACE VIEW {name}` AS "
        + (f"SELECT {quoted(data)} FROM {name}__log`" if head.kind == "replace" else f"SELECT {picks} FROM {winners('true')} WHERE NOT _latest.{DELETED}")
    )
    if len(live) == 1:
        return
    returned = ", ".join(f for f in fields if not f.startswith(f"`{DELETED}`"))
    after = f"{COMMIT} > _n" if head.order == "commit" else "true"
    functions = {
        "as_of": (returned, f"SELECT {picks} FROM {winners(f'{COMMIT} <= _n')} WHERE NOT _latest.{DELETED}"),
        "changes": (f"{returned}, {COMMIT} BIGINT, {DELETED} BOOLEAN", f"SELECT {picks}, _latest.{COMMIT}, _latest.{DELETED} FROM {winners(after)} WHERE _latest.{COMMIT} > _n"),
    }
    for suffix, (columns, body) in functions.items():
        # table functions take no database name, so they are the session's
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION `{db}__{table}__{suffix}`(_n BIGINT) RETURNS TABLE ({columns}) RETURN {body}")
