"""Prefix trie of conversations: union-find over the LCP edges of sorted neighbours, in descending depth.

1. Turns are numbered per conversation by a scan of sorted partitions, and every prefix gets a 128-bit name (``runs``), so two
   conversations share their first d turns exactly if their names at depth d are equal.  Conversations of any
   length are scanned as streams.
2. A conversation's names, as far as its prefix is shared, make one row; the turns after the first one that no other
   conversation shares are a chain of their own and go to the result at once.  Equal conversations become one row.
3. These rows are sorted by their names: conversations of one subtree are neighbours.  A partition unites neighbours by their
   LCP, deepest first; each union makes (or widens) a branching node, and the nodes below it are complete.
4. What a partition cannot complete are the prefixes of its first and its last row.  It is contracted to these
   two paths, with the sums of what hangs below them, and up to ``FAN`` neighbouring partitions are united in one task in the
   same way, in as many rounds as it takes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize, shuffle_partitions
from .runs import number_runs, sorted_rows
from .words import grouped

#: a conversation takes the first ``h`` turns of the one whose id is a multiple of GROUP; h is its crc32 modulo HEADS
GROUP, HEADS = 20, 4
#: turns that are always compared; deeper ones only as far as they are shared
SHALLOW = 64
#: forests united in one task; ids in one piece of a digest
FAN, PIECE = 64, 4096

NODE = "conv long, depth long, parent long, up_lo long, up_hi long, lo long, hi long, n long, children long, leaves long, saved long, ends string"
FOREST = "part long, side int, names array<struct<lo:long,hi:long>>, words array<long>, own array<struct<depth:long,n:long,conv:long,children:long,leaves:long,saved:long,ends:string>>"
_NODE_COLUMNS = [c.split()[0] for c in NODE.split(", ")]
_FOREST_TYPES = {
    "part": pa.int64(),
    "side": pa.int32(),
    "names": pa.list_(pa.struct([("lo", pa.int64()), ("hi", pa.int64())])),
    "words": pa.list_(pa.int64()),
    "own": pa.list_(pa.struct([(c, pa.string() if c == "ends" else pa.int64()) for c in ("depth", "n", "conv", "children", "leaves", "saved", "ends")])),
}


def _add(a: list, b: list) -> list:
    """Two shares of one node: conversations, least id, children, leaves, tokens saved below, digest of those that end there."""
    return [a[0] + b[0], b[1] if a[1] is None else a[1] if b[1] is None else min(a[1], b[1]), a[2] + b[2], a[3] + b[3], a[4] + b[4], a[5] or b[5]]


class _Component:
    """United neighbours: ``top`` is the depth of the highest node so far, ``share`` what is known of it, ``own`` the shares of
    nodes further up, ``waiting`` the finished nodes right below the top.  An open one holds the path of the first or last row."""

    __slots__ = ("row", "top", "share", "own", "waiting", "open")

    def __init__(self, row: int, depth: int, own: dict, is_open: bool):
        self.row, self.top, self.own, self.open, self.waiting = row, depth, own, is_open, []
        self.share = None if is_open else own.pop(depth)


def unite(names: list, words: list, own: list, final: bool):
    """Unite sorted rows (names and words per depth, from 1; ``own``: shares by depth) over their LCP edges.

    Returns the finished nodes as columns, and what is left as [(row, shares)]: the paths of the first and the last row, or
    nothing if ``final``.
    """
    out = {c: [] for c in _NODE_COLUMNS}
    n = len(names)
    parts = [_Component(i, len(names[i]), own[i], not final and i in (0, n - 1)) for i in range(n)]
    parent = list(range(n))

    def find(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    def finish(c: _Component) -> int:
        """The top of ``c`` is complete: its row in the result."""
        count, conv, children, leaves, saved, ends = c.share
        leaves = leaves if children else 1
        lo, hi = names[c.row][c.top - 1] if c.top else (0, 0)
        saved += (count - 1) * words[c.row][c.top - 1] if c.top else 0
        at = len(out["conv"])
        for i in c.waiting:
            out["parent"][i] = conv
        for column, value in zip(out.values(), (conv, c.top, None, None, None, lo, hi, count, children, leaves, saved, ends)):
            column.append(value)
        c.share = [count, conv, 1, leaves, saved, None]
        return at

    def lift(c: _Component, depth: int) -> None:
        while c.top > depth:
            c.waiting = [finish(c)]
            c.top -= 1
            if c.top in c.own:
                c.share = _add(c.share, c.own.pop(c.top))

    def merge_own(a: dict, b: dict) -> dict:
        if len(a) < len(b):
            a, b = b, a
        for depth, share in b.items():
            a[depth] = _add(a[depth], share) if depth in a else share
        return a

    edges = sorted(((_common(names[i], names[i + 1]), i) for i in range(n - 1)), key=lambda e: -e[0])
    left = []
    for depth, i in edges:
        ra, rb = find(i), find(i + 1)
        a, b = parts[ra], parts[rb]
        for c in (a, b):
            if not c.open:
                lift(c, depth)
        if a.open and b.open:  # the paths of the first and the last row part here: the shared shares go with the first
            up = {d: b.own.pop(d) for d in [d for d in b.own if d <= depth]}
            a.own = merge_own(a.own, up)
            left = [(a.row, a.own), (b.row, b.own)]
        elif a.open or b.open:
            o, c = (a, b) if a.open else (b, a)
            name = names[o.row][depth - 1] if depth else (0, 0)
            for k in c.waiting:  # their parent is not complete here: found by its name later
                out["up_lo"][k], out["up_hi"][k] = name
            c.own[depth] = c.share
            o.own = merge_own(o.own, c.own)
            a = o
        else:
            a.share = _add(a.share, b.share)
            small, large = sorted((a.waiting, b.waiting), key=len)
            large.extend(small)
            a.waiting, a.own = large, merge_own(a.own, b.own)
        parent[rb] = ra
        parts[ra] = a
    if final and n:
        root = parts[find(0)]
        lift(root, 0)
        finish(root)
    elif n == 1:
        left = [(0, parts[0].own)]
    return out, left


def _common(a: list, b: list) -> int:
    """Depth of the last common name: names stand for whole prefixes, so equal ones come first."""
    low, high = 0, min(len(a), len(b))
    while low < high:
        mid = (low + high + 1) // 2
        if a[mid - 1] == b[mid - 1]:
            low = mid
        else:
            high = mid - 1
    return low


def _result(part: int, names: list, words: list, own: list, final: bool) -> pa.RecordBatch:
    nodes, left = unite(names, words, own, final)
    types = {c: pa.string() if c == "ends" else pa.int64() for c in _NODE_COLUMNS}
    k = len(nodes["conv"])
    columns = {c: pa.array([*v, *[None] * len(left)], types[c]) for c, v in nodes.items()}
    forest = {
        "part": [part] * len(left),
        "side": list(range(len(left))),
        "names": [[{"lo": lo, "hi": hi} for lo, hi in names[r]] for r, _ in left],
        "words": [words[r] for r, _ in left],
        "own": [[dict(zip(("depth", "n", "conv", "children", "leaves", "saved", "ends"), (d, *s))) for d, s in o.items()] for _, o in left],
    }
    columns |= {c: pa.array([*[None] * k, *v], _FOREST_TYPES[c]) for c, v in forest.items()}
    return pa.RecordBatch.from_pydict(columns)


def _names(column: pa.Array) -> list[list[tuple[int, int]]]:
    flat, ends = column.flatten(), np.concatenate([[0], np.cumsum(column.value_lengths().to_numpy())]).tolist()
    pairs = list(zip(flat.field("lo").to_pylist(), flat.field("hi").to_pylist()))
    return [pairs[a:b] for a, b in zip(ends, ends[1:])]


def _first_round(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A partition of sorted rows."""
    names, words, own, part = [], [], [], None
    for batch in batches:
        if not batch.num_rows:
            continue
        part = batch.column("part")[0].as_py()
        names += _names(batch.column("names"))
        words += batch.column("words").to_pylist()
        for path, conv, n, more, ends in zip(names[len(own) :], *(batch.column(c).to_pylist() for c in ("conv", "n", "more", "ends"))):
            own.append({len(path): [n, conv, int(more), int(more), 0, ends]})
    if part is not None:
        yield _result(part, names, words, own, False)


def _later_round(final: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in grouped(batches, "task"):
            table = table.combine_chunks()
            own = [{s["depth"]: [s["n"], s["conv"], s["children"], s["leaves"], s["saved"], s["ends"]] for s in row} for row in table.column("own").to_pylist()]
            # the second path of a forest carries shares below the fork only: its end is among them
            yield _result(table.column("task")[0].as_py(), _names(table.column("names").chunk(0)), table.column("words").to_pylist(), own, final)

    return run


def _digests(members: DataFrame) -> DataFrame:
    """(lo, hi, ends): SHA-256 of the ascending ids of each group (lo, hi, conv), comma-joined.

    Ids are sorted over all partitions and joined in pieces; what one task streams for a group are its pieces.
    """
    keyed = members.withColumn("run", F.concat_ws(",", "lo", "hi"))
    placed = number_runs(sorted_rows(keyed, F.col("run"), F.col("conv")), "run")
    pieces = placed.groupBy("lo", "hi", F.expr(f"pos div {PIECE}").alias("piece")).agg(
        F.array_join(F.transform(F.sort_array(F.collect_list("conv")), lambda c: c.cast("string")), ",").alias("ids")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state, done = None, None, []
        for batch in batches:
            for lo, hi, ids in zip(*(batch.column(c).to_pylist() for c in ("lo", "hi", "ids"))):
                if (lo, hi) != key:
                    if key is not None:
                        done.append((*key, state.hexdigest()))
                    key, state = (lo, hi), hashlib.sha256(ids.encode())
                else:
                    state.update(b"," + ids.encode())
            if done:
                yield pa.RecordBatch.from_pydict(dict(zip(("lo", "hi", "ends"), map(list, zip(*done)))))
                done = []
        if key is not None:
            yield pa.RecordBatch.from_pydict({"lo": [key[0]], "hi": [key[1]], "ends": [state.hexdigest()]})

    return pieces.repartition(shuffle_partitions(members.sparkSession), "lo", "hi").sortWithinPartitions("lo", "hi", "piece").mapInArrow(run, "lo long, hi long, ends string")


def rebuilt_turns(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """((conv, pos, lo, hi, words) of all rebuilt turns, (conv) of all conversations).

    A turn is a 128-bit digest of role and text (null: empty) and the number of words of its text.  Turns ascend by ``turn`` (null
    first), equal ones by their digests; a repeated row is a turn of its own.  Rows without a conv_id belong to no conversation.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    turns = conversations.filter("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv"),
        "turn",
        F.xxhash64(F.lit(1), role, text).alias("lo"),
        F.xxhash64(F.lit(2), role, text).alias("hi"),
        F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long").alias("words"),
    )
    own = materialize(number_runs(sorted_rows(turns, F.col("conv"), F.asc_nulls_first("turn"), F.col("lo"), F.col("hi")), "conv").select("conv", "pos", "lo", "hi", "words"))
    h = F.crc32(F.col("conv").cast("string")) % HEADS
    convs = own.filter("pos = 0").select("conv")
    heads = own.filter((F.col("conv") % GROUP == 0) & (F.col("pos") < HEADS - 1)).withColumnRenamed("conv", "head")
    taken = convs.withColumn("head", F.col("conv") - F.col("conv") % GROUP).withColumn("h", h).join(heads, "head").filter("pos < h")
    columns = ["conv", "pos", "lo", "hi", "words"]
    return own.filter(F.col("pos") >= h).unionByName(taken.select(columns)), convs


def build_trie(conversations: DataFrame, shallow: int = SHALLOW, fan: int = FAN) -> DataFrame:
    """One row per distinct prefix of the rebuilt conversations: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens, ends_sha256.

    Null role or text is empty, a null conv_id is no conversation, an empty table gives no node (not even the
    root), other columns are ignored.  The remainder of a negative id has its sign.  A conversation is
    held as one row of 24 bytes a turn as far as another one shares its prefix (and for ``shallow`` turns).
    """
    spark = conversations.sparkSession
    turns, convs = rebuilt_turns(conversations)
    placed = number_runs(sorted_rows(turns.withColumn("w", F.col("words")), F.col("conv"), F.col("pos")).withColumnRenamed("pos", "old"), "conv", names=("lo", "hi"))
    prefixes = materialize(placed.select("conv", (F.col("pos") + 1).alias("depth"), "lo", "hi", F.col("lo_before").alias("up_lo"), F.col("hi_before").alias("up_hi"), "w", "last"))
    deep = prefixes.filter(F.col("depth") > shallow)
    shared = materialize(prefixes.filter(F.col("depth") >= shallow).groupBy("lo", "hi").count().filter("count > 1").select(F.col("lo").alias("up_lo"), F.col("hi").alias("up_hi")))
    kept = prefixes.filter(F.col("depth") <= shallow).unionByName(deep.join(shared, ["up_lo", "up_hi"], "left_semi"))
    tails = deep.join(shared, ["up_lo", "up_hi"], "left_anti")
    rows = kept.groupBy("conv").agg(
        F.sort_array(F.collect_list(F.struct("depth", "lo", "hi", "w"))).alias("path"), F.max(F.col("last").cast("int")).alias("ended")
    )
    whole = convs.join(rows, "conv", "left").select(
        "conv",
        F.coalesce(F.transform("path", lambda t: F.struct(t["lo"].alias("lo"), t["hi"].alias("hi"))), F.expr("array()").cast("array<struct<lo:long,hi:long>>")).alias("names"),
        F.coalesce(F.transform("path", lambda t: t["w"]), F.expr("array()").cast("array<long>")).alias("words"),
        (F.coalesce("ended", F.lit(1)) == 0).alias("more"),
    )
    last = F.when(F.size("names") > 0, F.element_at("names", -1))
    whole = materialize(whole.withColumn("lo", F.coalesce(last["lo"], F.lit(0))).withColumn("hi", F.coalesce(last["hi"], F.lit(0))))
    distinct = whole.groupBy("lo", "hi").agg(F.min("conv").alias("conv"), F.count(F.lit(1)).alias("n"), F.first("names").alias("names"), F.first("words").alias("words"), F.first("more").alias("more"))
    # one that goes on as a tail ends nowhere here
    ends = _digests(whole.filter("NOT more").select("lo", "hi", "conv"))
    ordered = sorted_rows(distinct.join(ends, ["lo", "hi"], "left").drop("lo", "hi"), F.col("names"))
    out = materialize(ordered.select("part", "names", "words", "conv", "n", "more", "ends").mapInArrow(_first_round, f"{NODE}, {FOREST}"))
    nodes, late = out.filter("conv IS NOT NULL").select(_NODE_COLUMNS), None
    forests = out.filter("conv IS NULL").drop(*_NODE_COLUMNS)
    groups = shuffle_partitions(spark)
    while True:
        final = groups <= fan
        tasks = forests.withColumn("task", F.expr("0L") if final else F.expr(f"part div {fan}"))
        out = materialize(
            tasks.repartition(shuffle_partitions(spark), "task").sortWithinPartitions("task", "part", "side").mapInArrow(_later_round(final), f"{NODE}, {FOREST}")
        )
        more = out.filter("conv IS NOT NULL").select(_NODE_COLUMNS)
        late = more if late is None else late.unionByName(more)
        if final:
            break
        forests, groups = out.filter("conv IS NULL").drop(*_NODE_COLUMNS), -(-groups // fan)
    every = nodes.unionByName(late)
    waiting = every.filter("up_lo IS NOT NULL").drop("parent")
    above = late.select(F.col("lo").alias("up_lo"), F.col("hi").alias("up_hi"), F.col("conv").alias("parent"))
    found = every.filter("up_lo IS NULL").unionByName(waiting.join(above, ["up_lo", "up_hi"]))
    nothing = F.sha2(F.lit(""), 256)
    chain = tails.select(
        F.col("conv").alias("conv_id"),
        "depth",
        F.col("conv").alias("parent_conv_id"),
        F.lit(1).cast("long").alias("n_convs"),
        F.when(F.col("last"), 0).otherwise(1).cast("long").alias("n_children"),
        F.lit(1).cast("long").alias("n_leaves"),
        F.lit(0).cast("long").alias("saved_tokens"),
        F.when(F.col("last"), F.sha2(F.col("conv").cast("string"), 256)).otherwise(nothing).alias("ends_sha256"),
    )
    return found.select(
        F.col("conv").alias("conv_id"),
        "depth",
        F.col("parent").alias("parent_conv_id"),
        F.col("n").alias("n_convs"),
        F.col("children").alias("n_children"),
        F.col("leaves").alias("n_leaves"),
        F.col("saved").alias("saved_tokens"),
        F.coalesce("ends", nothing).alias("ends_sha256"),
    ).unionByName(chain)
