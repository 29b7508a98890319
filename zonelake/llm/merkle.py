"""Merkle manifest of a table: a hash tree per group, a tree over the groups' roots, and proofs by a recursive query.

1. Every row is a leaf.  Leaves are sorted once by (group, id); their positions come from a scan of the sorted partitions.
2. Levels are built ``bits`` at a time: 2^bits neighbours meet in one small group, which gives the node above them and, for each
   of them, a stored row that links to that node and holds the siblings on the way.  So no group is larger than 2^bits rows
   and every pass has 1/2^bits of the rows of the one before.
3. The groups' roots, sorted, go through the same passes; a group's root is a row of its own, which links into the tree above.
4. ``verify`` climbs with Spark recursive queries: a row joins the row it links to, appends that row's siblings or folds
   them into the hash it presents, until nothing is above.  With bits=1 a step is one level; with 8 it is eight.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from .runs import number_runs, sorted_rows

LEAF = ("doc_id", "source", "lang", "n_chars", "text")
#: levels per stored row
BITS = 8
#: rows above the leaves that the climb may broadcast (under 4 KB each: a hash, its links and at most 40 or so siblings)
BROADCAST_NODES = 1 << 14
#: no session may cut the recursion: one row per leaf and step is made
ROW_LIMIT = "spark.sql.cteRecursionRowLimit"

_TOP = ""  # the tree over the groups' roots; a group's own tree is named "=" and its value, or "-" for null, which sorts first


def digest(*values: Column) -> Column:
    """Lowercase hex SHA-256 of the values: ``-`` for null, else the UTF-8 byte count, a colon and the value."""
    return F.sha2(F.concat(*[F.when(v.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(v.cast("string")).cast("string"), F.lit(":"), v.cast("string"))) for v in values]), 256)


def join_nodes(members: list[str], levels: int) -> tuple[str, list[list[str]]]:
    """The node ``levels`` above the members, and each member's siblings on the way ('' where it has none)."""
    paths = [[] for _ in members]
    nodes = members
    for k in range(levels):
        for i, path in enumerate(paths):
            beside = (i >> k) ^ 1
            path.append(nodes[beside] if beside < len(nodes) else "")
        nodes = [hashlib.sha256("".join(nodes[i : i + 2]).encode()).hexdigest() for i in range(0, len(nodes), 2)]
    return nodes[0], paths


def _blocks(bits: int, level: int):
    """Blocks of neighbours to rows: one per member, and one of the node above them (``top``)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = {c: [] for c in ("tree", "level", "idx", "hash", "row", "up_tree", "up_level", "up_idx", "path", "top")}

            def put(*values):
                for column, value in zip(out.values(), values):
                    column.append(value)

            for tree, block, many, members in zip(*(batch.column(c).to_pylist() for c in ("tree", "block", "many", "members"))):
                hashes = [m["hash"] for m in members]
                high, paths = join_nodes(hashes, bits if many else (len(hashes) - 1).bit_length())
                if many:
                    up = (tree, level + bits, block)
                elif tree == _TOP:
                    up = (None, None, None)
                else:
                    up = (tree, -1, 0)
                for m, path in zip(members, paths):
                    put(tree, level, m["idx"], m["hash"], m["row"], *up, path, False)
                put(tree, level + bits if many else -1, block, high, None, None, None, None, None, True)
            types = {"level": pa.int32(), "up_level": pa.int32(), "idx": pa.int64(), "up_idx": pa.int64(), "top": pa.bool_(), "path": pa.list_(pa.string()), "row": batch.schema.field("members").type.value_type.field("row").type}
            yield pa.RecordBatch.from_pydict({c: pa.array(v, types.get(c, pa.string())) for c, v in out.items()})

    return run


def _levels(rows: DataFrame, path: str, bits: int) -> tuple[list[str], int]:
    """Write the levels above ``rows`` (tree, idx, hash, row) under ``path``; their folders and the rows above the first one."""
    spark, folders, level, above = rows.sparkSession, [], 0, 0
    kind = rows.schema["row"].dataType.simpleString()
    schema = f"tree string, level int, idx long, hash string, row {kind}, up_tree string, up_level int, up_idx long, path array<string>, top boolean"
    while True:
        # a tree of one block ends there: only its first block can be in doubt
        longer = rows.filter(F.col("idx") == 1 << bits).select("tree", F.lit(0).cast("long").alias("block"), F.lit(True).alias("longer"))
        blocks = (
            rows.groupBy("tree", F.shiftright("idx", bits).alias("block"))
            .agg(F.sort_array(F.collect_list(F.struct("idx", "hash", "row"))).alias("members"))
            .join(longer, ["tree", "block"], "left")
            .select("tree", "block", (F.coalesce("longer", F.lit(False)) | (F.col("block") > 0)).alias("many"), "members")
        )
        seen = Observation()
        folder = f"{path}/{level}"
        blocks.mapInArrow(_blocks(bits, level), schema).observe(
            seen, F.count_if(F.col("top") & (F.col("level") >= 0)).alias("left"), F.count_if(~F.col("top")).alias("rows")
        ).write.option("compression", "zstd").parquet(folder)
        folders.append(folder)
        above += seen.get["rows"] if level else 0
        if not seen.get["left"]:
            return folders, above
        level += bits
        rows = spark.read.parquet(folder).filter("top AND level >= 0").select("tree", "idx", "hash", "row")


@dataclass
class Manifest:
    """``leaves`` and ``nodes`` are the stored rows (tree, level, idx, hash, row, up_tree, up_level, up_idx, path); ``root`` is None of an empty table."""

    leaves: DataFrame
    nodes: DataFrame
    n_nodes: int
    root: str | None


def build_manifest(docs: DataFrame, path: str, leaf: Column, presented: Column, id_col: str = "doc_id", group_col: str = "lang", bits: int = BITS) -> Manifest:
    """Store the tree of all rows under ``path`` (a folder shared by all executors).

    ``leaf`` is a row's hash and ``presented`` the one that ``verify`` shall fold for it (the same, or that of a changed row).
    Per group, leaves ascend by id (null first; equal ids by leaf hash, so repeated rows are leaves of their own in a fixed
    order); groups ascend by their UTF-8 bytes, null first.  Other columns are ignored.  An empty table has no root.
    """
    spark = docs.sparkSession
    group = F.col(group_col).cast("string")
    rows = docs.select(
        F.when(group.isNull(), F.lit("-")).otherwise(F.concat(F.lit("="), group)).alias("tree"),
        F.col(id_col).alias("id"),
        leaf.alias("hash"),
        presented.alias("presented"),
    )
    ordered = number_runs(sorted_rows(rows, F.col("tree"), F.asc_nulls_first("id"), F.col("hash")), "tree")
    folders, above = _levels(ordered.select("tree", F.col("pos").alias("idx"), "hash", F.struct("id", "presented").alias("row")), f"{path}/groups", bits)
    stored = [spark.read.parquet(f) for f in folders]
    ends = stored[0].filter("top AND level = -1").drop("row")
    for s in stored[1:]:
        ends = ends.unionByName(s.filter("top AND level = -1").drop("row"))
    named = ends.select(F.lit(_TOP).alias("run"), "tree", "hash")
    subroots = number_runs(sorted_rows(named, F.col("tree")), "run")
    tops, over = _levels(subroots.select(F.lit(_TOP).alias("tree"), F.col("pos").alias("idx"), "hash", F.struct("tree").alias("row")), f"{path}/roots", bits)
    top = [spark.read.parquet(f) for f in tops]
    # a group's root is found by its group: position 0 of level -1 of its tree
    first = top[0].filter("NOT top")
    columns = ["tree", "level", "idx", "hash", "up_tree", "up_level", "up_idx", "path", "turn"]
    nodes = first.select(F.col("row.tree").alias("tree"), F.lit(-1).alias("level"), F.lit(0).cast("long").alias("idx"), "hash", "up_tree", "up_level", "up_idx", "path", F.col("idx").alias("turn"))
    for s in [*stored[1:], *top[1:]]:
        nodes = nodes.unionByName(s.filter("NOT top").withColumn("turn", F.col("idx")).select(columns))
    root = top[-1].filter("top AND level = -1").select("hash").first()
    leaves = stored[0].filter("NOT top").select("tree", "idx", "hash", "row", "up_tree", "up_level", "up_idx", "path")
    return Manifest(leaves, nodes, above + over + first.count(), root and root["hash"])


#: siblings folded into a hash, nearest first; the bits of the position say on which side each of them stands
_FOLD = """aggregate(transform({p}, (s, i) -> named_struct('s', s, 'left', shiftright({i}, i) % 2 = 1)), {h},
    (h, x) -> sha2(CASE WHEN x.s = '' THEN h WHEN x.left THEN concat(x.s, h) ELSE concat(h, x.s) END, 256))"""


_LINK = "n.tree = c.up_tree AND n.level = c.up_level AND n.idx = c.up_idx"


def _climb(spark: SparkSession, query: str, **frames: DataFrame) -> DataFrame:
    """The result of a recursive query, stored in the checkpoint folder."""
    before = spark.conf.get(ROW_LIMIT, None)
    spark.conf.set(ROW_LIMIT, "-1")
    try:
        return spark.sql(query, **frames).checkpoint(eager=True)
    finally:
        spark.conf.set(ROW_LIMIT, before) if before is not None else spark.conf.unset(ROW_LIMIT)


def verify(manifest: Manifest) -> DataFrame:
    """(id, leaf, subroot, root, proof_sha256, folded_root, verified) of every leaf, by recursive climbs of the stored rows.

    ``folded_root`` is what the presented hash folds to, and ``verified`` whether that is the root; ``proof_sha256`` is the digest
    of all siblings from the leaf up to the root.  Leaves below one stored row have the same siblings from there on: a first
    climb appends them once per such row, a second one starts from every leaf and folds, so what travels from step to step is a
    row of bounded size.  The rows above the leaves (1/2^bits of them) are broadcast up to BROADCAST_NODES and
    joined by their keys beyond it.
    """
    spark = manifest.leaves.sparkSession
    hint = "/*+ BROADCAST(n) */" if manifest.n_nodes <= BROADCAST_NODES else ""
    ways = _climb(
        spark,
        f"""
        WITH RECURSIVE climb(tree, level, idx, up_tree, up_level, up_idx, siblings) AS (
            SELECT n.tree, n.level, n.idx, up_tree, up_level, up_idx, path FROM {{nodes}} n
            UNION ALL
            SELECT {hint} c.tree, c.level, c.idx, n.up_tree, n.up_level, n.up_idx, concat(c.siblings, n.path) FROM climb c JOIN {{nodes}} n ON {_LINK}
        )
        SELECT tree, level, idx, array_join(siblings, '') AS proof FROM climb WHERE up_tree IS NULL
        """,
        nodes=manifest.nodes,
    )
    fold = _FOLD.format(p="path", i="c.idx", h="row.presented"), _FOLD.format(p="n.path", i="n.turn", h="lower(hex(c.folded))")
    climbed = _climb(
        spark,
        f"""
        WITH RECURSIVE climb(id, leaf, proof, up_tree, up_level, up_idx, folded, subroot) AS (
            SELECT {hint} row.id, unhex(hash), unhex(sha2(concat(array_join(path, ''), n.proof), 256)), up_tree, up_level, up_idx, unhex({fold[0]}), CAST(NULL AS BINARY)
            FROM {{leaves}} c JOIN {{ways}} n ON {_LINK}
            UNION ALL
            SELECT {hint} c.id, c.leaf, c.proof, n.up_tree, n.up_level, n.up_idx, unhex({fold[1]}), CASE WHEN n.level = -1 THEN unhex(n.hash) ELSE c.subroot END
            FROM climb c JOIN {{nodes}} n ON {_LINK}
        )
        SELECT id, leaf, subroot, proof, folded FROM climb WHERE up_tree IS NULL
        """,
        leaves=manifest.leaves,
        ways=ways,
        nodes=manifest.nodes,
    )
    root, text = F.lit(manifest.root).cast("string"), lambda c: F.lower(F.hex(c))
    return climbed.select(
        "id",
        text("leaf").alias("leaf"),
        text("subroot").alias("subroot"),
        root.alias("root"),
        text("proof").alias("proof_sha256"),
        text("folded").alias("folded_root"),
        (text("folded") == root).alias("verified"),
    )


def tampered_leaf(id_col: str = "doc_id", columns: tuple[str, ...] = LEAF, changed: str = "n_chars", every: int = 7) -> Column:
    """The hash of the row with 1 added to ``changed`` where ``every`` divides the crc32 of the decimal id, else of the row as it is."""
    more = [(F.col(c).cast("decimal(38,0)") + 1) if c == changed else F.col(c) for c in columns]
    hit = F.crc32(F.col(id_col).cast("string")) % every == 0
    return F.when(hit, digest(*more)).otherwise(digest(*[F.col(c) for c in columns]))
