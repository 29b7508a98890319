from __future__ import annotations

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from zonelake.llm import merkle
from zonelake.llm.queries import QUERIES
from zonelake.llm.runs import number_runs, sorted_rows

from .conftest import tuples

COLUMNS = ("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(row):
    return H(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in row])


def tree(hashes):
    levels = [hashes]
    while len(levels[-1]) > 1:
        levels.append([H(*levels[-1][i : i + 2]) for i in range(0, len(levels[-1]), 2)])
    return levels


def siblings(levels, i):
    out = []
    for level in levels[:-1]:
        out.append((level[i ^ 1] if i ^ 1 < len(level) else "", i & 1))
        i >>= 1
    return out


def brute(rows):
    """The contract, row by row; a row is (doc_id, source, lang, n_chars, text)."""
    groups = {}
    for r in rows:
        groups.setdefault(r[2], []).append(r)
    names = sorted(groups, key=lambda k: (k is not None, (k or "").encode()))
    placed = {k: sorted(((r[0] is not None, r[0] or 0, leaf_of(r), r) for r in groups[k]), key=lambda t: t[:3]) for k in names}
    trees = {k: tree([p[2] for p in placed[k]]) for k in names}
    top = tree([trees[k][-1][0] for k in names])
    out = []
    for turn, k in enumerate(names):
        for i, (_, _, leaf, r) in enumerate(placed[k]):
            way = siblings(trees[k], i) + siblings(top, turn)
            changed = list(r)
            if r[0] is not None and r[3] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0:
                changed[3] += 1
            folded = leaf_of(changed)
            for s, left in way:
                folded = H(s, folded) if left else H(folded, s)
            out.append((r[0], leaf, trees[k][-1][0], top[-1][0], H(*[s for s, _ in way]), folded, folded == top[-1][0]))
    return sorted(out, key=lambda t: tuple((v is not None, v) for v in t))


def source_rows(docs):
    return [tuple(r) for r in docs.select("doc_id", "source", "lang", "n_chars", "text").collect()]


def manifest(docs, path, bits=merkle.BITS):
    leaf = merkle.digest(*[F.col(c) for c in merkle.LEAF])
    built = merkle.build_manifest(docs, str(path), leaf, merkle.tampered_leaf(), bits=bits)
    return built, merkle.verify(built).withColumnRenamed("id", "doc_id")


@pytest.mark.parametrize("bits", [1, 3, 8])
def test_edge_rows_at_any_number_of_levels_a_step(edge, tmp_path, bits):
    """Nulls in any column, repeated rows, long texts, clashing names: one verdict per row, as by hand."""
    docs = edge.withColumn("n_chars", F.when(F.col("doc_id") % 2 == 0, F.length("text").cast("long")))
    _, got = manifest(docs, tmp_path / "m", bits)
    assert tuples(got, *COLUMNS) == brute(source_rows(docs))


def test_one_leaf_one_group_and_the_largest_number(spark, tmp_path):
    rows = [(18, "s", None, (1 << 63) - 1, "t")]  # 7 divides the crc32 of "18"?  the sum must not overflow either way
    rows += [(i, "s", None, (1 << 63) - 1, "t") for i in range(40)]
    docs = spark.createDataFrame(rows[:1], "doc_id long, source string, lang string, n_chars long, text string")
    assert tuples(manifest(docs, tmp_path / "a")[1], *COLUMNS) == brute(rows[:1])
    docs = spark.createDataFrame(rows, docs.schema)
    got = tuples(manifest(docs, tmp_path / "b", 2)[1], *COLUMNS)
    assert got == brute(rows) and any(not r[-1] for r in got)


def test_group_values_that_look_like_names_of_the_tree(spark, tmp_path):
    rows = [(i, None, lang, 1, "x") for i, lang in enumerate([None, "", "-", "=", "=a", "a", "é", "\U0001f642", "z", None, "", "￿"])]
    docs = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")
    assert tuples(manifest(docs, tmp_path / "m", 2)[1], *COLUMNS) == brute(rows)


def test_an_empty_table_has_no_root(none, tmp_path):
    built, got = manifest(none, tmp_path / "m")
    assert built.root is None and got.collect() == []


def test_beyond_the_broadcast_bound(sf, spark, tmp_path, monkeypatch):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    monkeypatch.setattr(merkle, "BROADCAST_NODES", 0)
    assert tuples(manifest(docs, tmp_path / "m", 2)[1], *COLUMNS) == brute(source_rows(docs))


def test_stored_rows_link_up_to_the_root(sf, spark, tmp_path):
    """Every link names a stored row of the right level; only rows beside the root have none."""
    built, _ = manifest(spark.read.parquet(f"{sf}/documents.parquet"), tmp_path / "m", 3)
    nodes = {(r["tree"], r["level"], r["idx"]) for r in built.nodes.collect()}
    links = {(r["up_tree"], r["up_level"], r["up_idx"]) for r in built.leaves.unionByName(built.nodes, allowMissingColumns=True).collect()}
    assert links - {(None, None, None)} == nodes and len(nodes) == built.nodes.count() == built.n_nodes


def test_query_equals_the_contract(sf, spark):
    got = QUERIES["op11_merkle_manifest"](spark, sf)
    assert tuples(got, *COLUMNS) == brute(source_rows(spark.read.parquet(f"{sf}/documents.parquet")))


def test_runs_over_many_partitions(spark):
    """Positions, sums and names of runs that span partitions, against one pass by hand."""
    from zonelake.llm.runs import BASE

    rows = [(k, i, i * 7919 - 5, i % 3) for k, n in ((1, 1), (2, 5000), (3, 2), (4, 700), (5, 1)) for i in range(n)]
    frame = spark.createDataFrame(rows, "k long, i long, code long, w long").repartition(5)
    got = number_runs(sorted_rows(frame, F.col("k"), F.col("i")), "k", names=("code",), sums=("w",)).select("k", "i", "pos", "code", "w").collect()
    name, total = {}, {}
    want = []
    for k, i, code, w in rows:
        name[k] = (name.get(k, 0) + code * pow(BASE, i, 1 << 64)) % (1 << 64)
        total[k] = total.get(k, 0) + w
        want.append((k, i, i, name[k], total[k]))
    assert sorted((r[0], r[1], r[2], r[3] % (1 << 64), r[4]) for r in got) == want
