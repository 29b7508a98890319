"""Keyed zone tables: replace, upsert, delete, time travel, evolution, catalog."""

from __future__ import annotations

import os
from pathlib import Path

import pytest
from conftest import rows
from pyspark.sql import functions as F

from zonelake.sinks import changelog
from zonelake.sinks.zone import ZoneStore
from zonelake.sources.catalog import Zones


@pytest.fixture()
def store(tmp_dir):
    return ZoneStore(tmp_dir, Zones(f"z{os.path.basename(tmp_dir)[-6:].lower().replace('-', '_')}"))


def test_fixture_commit_log_with_schema_evolution(spark, store):
    """FIXTURES §2: (a,1,x) (b,1,y) then (a,2,x2,n=5) (c,1,z,n=6)."""
    first = spark.createDataFrame([("a", 1, "x"), ("b", 1, "y")], "k string, o long, v string")
    second = spark.createDataFrame([("a", 2, "x2", 5), ("c", 1, "z", 6)], "k string, o long, v string, n long")
    assert store.write(first, "trusted", "t", "k", "o", mode="upsert") == 1
    assert store.write(second, "trusted", "t", "k", "o", mode="upsert") == 2
    as_of_1 = store.read(spark, "trusted", "t", as_of=1)
    assert rows(as_of_1, "k", "v") == [("a", "x"), ("b", "y")]
    current = store.read(spark, "trusted", "t")
    assert rows(current, "k", "v", "n") == [("a", "x2", 5), ("b", "y", None), ("c", "z", 6)]
    # catalog: the view shows the current table, the log table all commits
    db = store.zones.database("trusted")
    assert rows(spark.table(f"{db}.t"), "k", "v", "n") == [("a", "x2", 5), ("b", "y", None), ("c", "z", 6)]
    assert spark.table(f"{db}.t__log").count() == 4
    assert rows(spark.table(f"{db}.t__log"), "_commit") == [(1,), (1,), (2,), (2,)]


def test_replace_hides_earlier_commits_and_dedups(spark, store):
    old = spark.createDataFrame([("a", 1, "old"), ("z", 1, "gone")], "k string, o long, v string")
    new = spark.createDataFrame([("a", 3, "new"), ("a", 5, "newer"), ("b", 1, "b")], "k string, o long, v string")
    store.write(old, "curated", "r", "k", "o")
    store.write(new, "curated", "r", "k", "o")
    assert rows(store.read(spark, "curated", "r"), "k", "v") == [("a", "newer"), ("b", "b")]
    assert rows(store.read(spark, "curated", "r", as_of=1), "k", "v") == [("a", "old"), ("z", "gone")]


def test_upsert_twice_changes_nothing_and_delete(spark, store):
    batch = spark.createDataFrame([("a", 1, "x"), ("a", 2, "y"), ("b", 1, "q")], "k string, o long, v string")
    store.write(batch, "trusted", "u", "k", "o", mode="upsert")
    once = rows(store.read(spark, "trusted", "u"))
    store.write(batch, "trusted", "u", "k", "o", mode="upsert")
    assert rows(store.read(spark, "trusted", "u")) == once == [("a", 2, "y"), ("b", 1, "q")]
    store.delete(spark.createDataFrame([("a",)], "k string"), "trusted", "u")
    assert rows(store.read(spark, "trusted", "u"), "k") == [("b",)]
    changes = store.changes(spark, "trusted", "u", since=2)
    assert rows(changes, "k", "_commit", "_deleted") == [("a", 3, True)]
    # re-inserting after the delete brings the key back
    store.write(spark.createDataFrame([("a", 0, "back")], "k string, o long, v string"), "trusted", "u", "k", "o",
                mode="upsert")
    assert rows(store.read(spark, "trusted", "u"), "k", "v") == [("a", "back"), ("b", "q")]
    assert rows(store.read(spark, "trusted", "u", as_of=3), "k") == [("b",)]


def test_null_key_and_duplicate_key_refused(spark, store):
    bad = spark.createDataFrame([(None, 1)], "k string, o long")
    with pytest.raises(ValueError, match="null record key"):
        store.write(bad, "trusted", "n", "k", "o")
    assert store.commits(spark, "trusted", "n") == []
    dup = spark.createDataFrame([("a", 1), ("a", 2)], "k string, o long")
    with pytest.raises(ValueError, match="duplicated"):
        store.write(dup, "trusted", "n", "k", "o", unique=True, check_unique=True)
    assert store.commits(spark, "trusted", "n") == []
    # the failed attempt left an unrecorded directory, which nothing reads
    assert store.write(dup, "trusted", "n", "k", "o") == 1
    assert rows(store.read(spark, "trusted", "n")) == [("a", 2)]


def test_partitioned_commit(spark, store):
    df = spark.createDataFrame([("a", 1, "p"), ("b", 2, "q")], "k string, o long, part string")
    store.write(df, "curated", "p", "k", "o", partition_by="part")
    assert rows(store.read(spark, "curated", "p"), "k", "part") == [("a", "p"), ("b", "q")]


def test_snapshot_as_of_latest_equals_current(spark):
    log = spark.createDataFrame(
        [("a", 1, 1, False), ("a", 0, 2, False), ("b", 1, 2, False), ("b", None, 3, True)],
        "k string, o long, _commit long, _deleted boolean",
    )
    cur = changelog.snapshot(log, "k", "o")
    assert rows(cur) == [("a", 0)]
    assert rows(changelog.snapshot(log, "k", "o", as_of=3)) == rows(cur)
    assert rows(changelog.snapshot(log, "k", "o", as_of=2)) == [("a", 0), ("b", 1)]


def test_a_failed_read_of_the_commits_is_an_error(spark, store):
    """Only a missing folder means an empty table; a finished commit is never written again."""
    row = lambda k: spark.createDataFrame([(k, 1)], "k string, o long")
    for k in "ab":
        store.write(row(k), "trusted", "t", "k", "o", mode="upsert")
    bad = f"{store.path('trusted', 't')}/commits/part-bad.parquet"
    with open(bad, "w") as fh:
        fh.write("no parquet")
    with pytest.raises(Exception, match="part-bad|not a Parquet"):
        store.write(row("c"), "trusted", "t", "k", "o", mode="upsert")
    os.remove(bad)
    assert store.write(row("c"), "trusted", "t", "k", "o", mode="upsert") == 3
    assert rows(store.read(spark, "trusted", "t"), "k") == [("a",), ("b",), ("c",)]
    assert [c.commit for c in store.commits(spark, "trusted", "t")] == [1, 2, 3]


def test_leftovers_of_a_crashed_writer_are_not_read(spark, store):
    """Rows of a commit that was not finished are neither read nor kept when its number is written."""
    frame = spark.createDataFrame([("a", 1)], "k string, o long")
    store.write(frame, "trusted", "t", "k", "o")
    crashed = spark.createDataFrame([("z", 9, False)], "k string, o long, _deleted boolean")
    crashed.write.parquet(f"{store.path('trusted', 't')}/rows/_commit=2")
    os.makedirs(f"{store.path('trusted', 't')}/commits/_temporary/0")
    table = f"{store.zones.database('trusted')}.t"
    assert rows(store.read(spark, "trusted", "t")) == rows(spark.table(table)) == [("a", 1)]
    assert store.write(frame.selectExpr("'b' AS k", "o"), "trusted", "t", "k", "o", mode="upsert") == 2
    assert rows(store.read(spark, "trusted", "t"), "k") == rows(spark.table(table), "k") == [("a",), ("b",)]


def test_replace_begins_a_new_schema(spark, store):
    old = spark.createDataFrame([("a", 1, 5, "x")], "k string, o long, v int, w string")
    new = spark.createDataFrame([("a", 2, "five")], "k string, o long, v string")
    store.write(old, "trusted", "t", "k", "o")
    with pytest.raises(ValueError, match="column v is int"):
        store.write(new, "trusted", "t", "k", "o", mode="upsert")
    store.write(new, "trusted", "t", "k", "o")
    assert store.read(spark, "trusted", "t").collect() == [("a", 2, "five")]
    assert store.read(spark, "trusted", "t", as_of=1).collect() == [("a", 1, 5, "x")]
    assert spark.table(f"{store.zones.database('trusted')}.t").collect() == [("a", 2, "five")]


def test_partition_values_keep_their_type_and_deletes_work(spark, store):
    frame = spark.createDataFrame([("a", 1, "007"), ("b", 1, "x"), ("c", 1, None)], "k string, o long, part string")
    store.write(frame, "trusted", "t", "k", "o", partition_by="part")
    table = f"{store.zones.database('trusted')}.t"
    assert rows(store.read(spark, "trusted", "t"), "k", "part") == rows(spark.table(table), "k", "part") == [("a", "007"), ("b", "x"), ("c", None)]
    store.delete(frame.where("k = 'b'"), "trusted", "t")
    assert rows(store.read(spark, "trusted", "t"), "k", "part") == rows(spark.table(table), "k", "part") == [("a", "007"), ("c", None)]
    assert dict(store.log(spark, "trusted", "t").dtypes)["_commit"] == "bigint"


def test_changes_report_what_a_replace_left_out(spark, store):
    both = spark.createDataFrame([("a", 1), ("z", 1)], "k string, o long")
    store.write(both, "trusted", "t", "k", "o")
    store.write(both.where("k = 'a'"), "trusted", "t", "k", "o")
    assert rows(store.changes(spark, "trusted", "t", since=1), "k", "_commit", "_deleted") == [("a", 2, False), ("z", 2, True)]
    assert rows(store.changes(spark, "trusted", "t", since=0), "k", "_deleted") == [("a", False)]
    assert store.changes(spark, "trusted", "t", since=2).collect() == []


def test_event_order(spark, store):
    """A late record changes nothing; after a delete only later commits count."""
    row = lambda o, v: spark.createDataFrame([("a", o, v)], "k string, o long, v string")
    write = lambda o, v: store.write(row(o, v), "trusted", "t", "k", "o", mode="upsert", order="event")
    table = f"{store.zones.database('trusted')}.t"
    write(9, "new")
    write(3, "late")
    assert store.read(spark, "trusted", "t").collect() == spark.table(table).collect() == [("a", 9, "new")]
    assert store.changes(spark, "trusted", "t", since=1).collect() == []
    store.delete(row(0, ""), "trusted", "t")
    assert store.read(spark, "trusted", "t").collect() == spark.table(table).collect() == []
    write(1, "again")
    assert store.read(spark, "trusted", "t").collect() == spark.table(table).collect() == [("a", 1, "again")]
    with pytest.raises(ValueError):
        store.write(row(1, ""), "trusted", "t", "k", "o", order="size")


def test_a_batch_is_committed_once(spark, store):
    frame = spark.createDataFrame([("a", 1)], "k string, o long")
    assert store.write(frame, "trusted", "t", "k", "o", mode="upsert", batch="stream#0") == 1
    assert store.write(frame, "trusted", "t", "k", "o", mode="upsert", batch="stream#0") == 1
    assert store.write(frame, "trusted", "t", "k", "o", mode="upsert", batch="stream#1") == 2


def test_types_widen_over_commits_and_others_are_refused(spark, store):
    """int to bigint and float to double, in either order; the rows of earlier commits are read in the wider type."""
    commits = [("a", 1, 5, 0.5, "k string, o long, v int, w float"), ("b", 1, 1 << 40, 0.1, "k string, o long, v long, w double"), ("c", 1, 7, 0.25, "k string, o long, v smallint, w float")]
    for k, o, v, w, schema in commits:
        store.write(spark.createDataFrame([(k, o, v, w)], schema), "trusted", "t", "k", "o", mode="upsert")
    table = spark.table(f"{store.zones.database('trusted')}.t")
    want = [("a", 1, 5, 0.5), ("b", 1, 1 << 40, 0.1), ("c", 1, 7, 0.25)]
    assert rows(store.read(spark, "trusted", "t")) == rows(table) == want
    assert dict(table.dtypes)["v"] == "bigint" and dict(table.dtypes)["w"] == "double"
    assert dict(store.read(spark, "trusted", "t", as_of=1).dtypes)["v"] == "int"
    for other in ("v string", "v double", "v boolean"):
        with pytest.raises(ValueError, match="column v is bigint"):
            store.write(spark.createDataFrame([("d", 1, None)], f"k string, o long, {other}"), "trusted", "t", "k", "o", mode="upsert")
    assert len(store.commits(spark, "trusted", "t")) == 3


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_table_functions_and_pruned_partitions(spark, store):
    """As of and changes as SQL functions, equal to the reads; only the wanted commits' partitions are listed."""
    for n, k in enumerate("abca", 1):
        store.write(spark.createDataFrame([(k, n)], "k string, o long"), "trusted", "t", "k", "o", mode="upsert")
    store.delete(spark.createDataFrame([("b",)], "k string"), "trusted", "t")
    db = store.zones.database("trusted")
    for n in range(6):
        got = rows(spark.sql(f"SELECT k, o FROM {db}__t__as_of({n})"))
        assert got == (rows(store.read(spark, "trusted", "t", as_of=n)) if n else [])
        columns = "k, o, _commit, _deleted"
        assert rows(spark.sql(f"SELECT {columns} FROM {db}__t__changes({n})")) == rows(store.changes(spark, "trusted", "t", since=n).select(*columns.split(", ")))
    for df in (store.read(spark, "trusted", "t", as_of=2), spark.sql(f"SELECT * FROM {db}__t__as_of(2)")):
        assert "_commit" in _plan(df).split("PartitionFilters: [")[1].split("]")[0]
        assert sorted({f.split("_commit=")[1].split("/")[0] for f in df.inputFiles()}) >= ["1", "2"]
    changed = store.changes(spark, "trusted", "t", since=3)
    assert "PartitionFilters: [isnotnull(_commit" in _plan(changed)


def test_the_layout_of_partitions_is_the_tables(spark, store):
    frame = spark.createDataFrame([("a", 1, "p")], "k string, o long, part string")
    store.write(frame, "trusted", "t", "k", "o", partition_by="part")
    with pytest.raises(ValueError, match="is partitioned by"):
        store.write(frame, "trusted", "t", "k", "o", partition_by="o")
    store.write(frame.selectExpr("'b' AS k", "o", "part"), "trusted", "t", "k", "o", mode="upsert")
    assert rows(store.read(spark, "trusted", "t"), "k", "part") == [("a", "p"), ("b", "p")]


def test_partitions_of_the_batch_are_replaced_and_no_others(spark, tmp_dir):
    from zonelake.sinks.partitions import read_partitions, replace_partitions

    schema = "k string, o long, part string"
    name, path = f"p{os.path.basename(tmp_dir)[-6:].lower().replace('-', '_')}_trusted.parts", os.path.join(tmp_dir, "t")
    put = lambda data: replace_partitions(spark.createDataFrame(data, schema), path, "part", "k", "o", name=name)
    put([("a", 1, "007"), ("a", 2, "007"), ("b", 1, "x"), ("c", 1, None)])
    assert rows(spark.table(name)) == [("a", 2, "007"), ("b", 1, "x"), ("c", 1, None)]
    put([("d", 1, "007"), ("e", 1, None), ("f", 1, "new")])
    put([])
    want = [("b", 1, "x"), ("d", 1, "007"), ("e", 1, None), ("f", 1, "new")]
    assert rows(spark.table(name)) == rows(read_partitions(spark, path, spark.createDataFrame([], schema).schema)) == want
    assert "PartitionFilters: [isnotnull(part" in _plan(spark.table(name).where("part = 'x'"))


def test_rows_are_counted_while_they_are_written(spark, store):
    """Also of an empty batch, a delete and a partitioned table; a null key is told with its count."""
    schema = "k string, o long, part string"
    put = lambda data, **kw: store.write(spark.createDataFrame(data, schema), "trusted", "t", "k", "o", mode="upsert", partition_by="part", **kw)
    put([("a", 1, "x"), ("a", 2, "x"), ("b", 1, None)])
    put([])
    store.delete(spark.createDataFrame([("a",), ("a",)], "k string"), "trusted", "t")
    with pytest.raises(ValueError, match="2 rows with a null record key"):
        put([(None, 1, "x"), (None, 2, "x"), ("c", 1, "x")], unique=True)
    assert [(c.commit, c.kind, c.rows) for c in store.commits(spark, "trusted", "t")] == [(1, "upsert", 2), (2, "upsert", 0), (3, "delete", 1)]
    assert rows(store.read(spark, "trusted", "t")) == [("b", 1, None)]


def test_running_numbers_are_stored_as_differences(spark, store):
    """A numbered table takes less than a byte for each of its running numbers, and reads back as it was."""
    numbered = spark.range(0, 200_000, numPartitions=1).select((F.col("id") / 50_000).cast("long").alias("k"), (F.col("id") % 50_000 + 1).alias("rn"))
    store.write(numbered, "trusted", "numbers", ["k", "rn"], "rn", unique=True, numbered="rn")
    size = sum(p.stat().st_size for p in Path(store.path("trusted", "numbers")).rglob("*.parquet"))
    assert size < 200_000, size
    assert store.read(spark, "trusted", "numbers").exceptAll(numbered).count() == 0


def test_stored_pairs_cost_less_than_their_columns(spark, store):
    """The feature table repeats an instant's tuples for each of its devices: a pair takes a fraction of a byte, its number included."""
    from zonelake.operators.joins import ml_features

    steps = spark.range(24 * 100).select(F.floor(F.col("id") / 100).alias("t"), (F.col("id") % 100).alias("serialnumber")).where("(serialnumber * 7 + t * 3) % 5 > 0")
    devices = steps.selectExpr("t AS sensorreadingtime", "serialnumber", "CAST(serialnumber % 9 AS INT) AS distancefromobject", "serialnumber div 2 AS email", "1L AS registrationdate")
    draw = "(xxhash64(id) & 65535) / 100D"
    accel = spark.range(24 * 250).selectExpr("id % 24 AS timestamp", f"{draw} AS x", f"2 * {draw} AS y", "CAST(id % 90 AS DOUBLE) AS z", "2L AS w")
    pairs = ml_features(devices, accel, accel_weight="w")
    store.write(pairs, "curated", "features", ["email", "rn"], "sensorreadingtime", unique=True, numbered="rn")
    stored, size = store.read(spark, "curated", "features"), sum(p.stat().st_size for p in Path(store.path("curated", "features")).rglob("*.parquet"))
    n = stored.count()
    assert n == 24 * 80 * 250 * 2 and size < n / 2, (n, size)
    assert stored.exceptAll(pairs).isEmpty() and pairs.exceptAll(stored).isEmpty()


def test_numbers_of_short_keys_are_stored_as_differences(spark, store):
    """A dictionary of the numbers does not overflow where keys are short; they are stored as differences all the same."""
    import pyarrow.parquet as pq

    numbered = spark.range(0, 200_000, numPartitions=1).selectExpr("id div 100 AS k", "id % 100 + 1 AS rn")
    store.write(numbered, "trusted", "short", ["k", "rn"], "rn", unique=True, numbered="rn")
    found = [pq.ParquetFile(p).metadata.row_group(0) for p in Path(store.path("trusted", "short")).rglob("_commit=1/*.parquet")]
    assert {e for g in found for i in range(g.num_columns) if (c := g.column(i)).path_in_schema == "rn" for e in c.encodings} == {"DELTA_BINARY_PACKED"}
    assert store.read(spark, "trusted", "short").exceptAll(numbered).isEmpty()
