"""Near-duplicate join on word n-grams: MinHash bands find candidates, full n-gram sets decide.

1. A signature per document (one Python pass): the hashes of its bands and a 128-bit digest of its n-gram set.  Documents
   with equal sets form one class and go on as one representative.
2. Representatives meet on band hashes.  Equal hashes of one batch are linked at once, so a hash that a third of all
   documents share sends one row per batch; links form stars, never all pairs.
3. Connected components of these links hold every candidate pair.  A component's texts are dealt into blocks and every pair of
   blocks is compared on full sets in one task; what leaves it is each text's number of links and one
   link to the least text that it hangs together with, so rows grow with texts, not with pairs.
4. Components of the verified links are the near-duplicate classes.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize, shuffle_partitions
from .components import connected_components
from .words import Names, grouped, hash_words, mix, slices, split_words

WORDS, SIMILARITY = 5, Fraction(4, 5)
#: target recall of candidates at the similarity bound, and the most hash functions to spend on it
RECALL, MAX_HASHES = 0.9999, 200
#: texts and n-grams of a block
BLOCK_TEXTS, BLOCK_GRAMS = 512, 2_000_000


def choose_bands(similarity: float = float(SIMILARITY), recall: float = RECALL, most: int = MAX_HASHES) -> tuple[int, int]:
    """(bands, rows): the most rows a band (the fewest false candidates) for which the bands that reach ``recall`` at
    ``similarity``, 1 - (1 - s^rows)^bands, need at most ``most`` hashes."""
    best = None
    for rows in range(1, most + 1):
        hit = similarity**rows
        if hit * most < 1:  # no more than most / rows bands to come: far from the recall
            break
        bands = 1 if hit >= 1 else math.ceil(math.log(1 - recall) / math.log1p(-hit))
        if bands * rows <= most:
            best = (bands, rows)
    if best is None:
        raise ValueError("no bands reach the recall")
    return best


def _grams(texts: pa.Array, n: int):
    """(row, name) of the distinct n-grams, sorted by both; a text of under n words is one n-gram, one without words none."""
    words = split_words(texts)
    names = Names(hash_words(words.words)[words.codes] if len(words.codes) else np.zeros(0, np.uint64))
    at, rows = np.arange(len(words.codes)), words.rows()
    room = words.starts[1:][rows] - at
    whole = (room >= n) | (at == words.starts[:-1][rows])
    at, rows = at[whole], rows[whole]
    name = names.of(at, np.minimum(room[whole], n))
    order = np.lexsort((name, rows))
    rows, name = rows[order], name[order]
    new = np.ones(len(rows), dtype=bool)
    new[1:] = (rows[1:] != rows[:-1]) | (name[1:] != name[:-1])
    return rows[new], name[new]


def _signatures(n: int, bands: int, rows_each: int):
    rng = np.random.default_rng(20_240_501)
    factor = rng.integers(0, 1 << 32, bands * rows_each, dtype=np.uint32) | np.uint32(1)
    shift = rng.integers(0, 1 << 32, bands * rows_each, dtype=np.uint32)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            row, name = _grams(batch.column("text"), n)
            size = np.bincount(row, minlength=len(batch)).astype(np.int64)
            have = np.flatnonzero(size)
            begin = (np.cumsum(size) - size)[have]
            d1, d2 = (np.zeros(len(batch), np.uint64) for _ in range(2))
            keys = np.zeros((len(batch), bands), np.uint64)
            if len(have):
                d1[have] = np.add.reduceat(mix(name ^ np.uint64(0x5851F42D4C957F2D)), begin)
                d2[have] = np.add.reduceat(mix(name + np.uint64(0x14057B7EF767814F)), begin)
                x = (name >> np.uint64(32)).astype(np.uint32) ^ name.astype(np.uint32)
                for b in range(bands):
                    key = np.full(len(have), b + 1, np.uint64)
                    for k in range(b * rows_each, (b + 1) * rows_each):
                        key = mix(key * np.uint64(0x2545F4914F6CDD1D) + np.minimum.reduceat(x * factor[k] + shift[k], begin))
                    keys[have, b] = key
            flat = keys[have].reshape(-1).view(np.int64)
            offsets = np.concatenate([[0], np.cumsum((size > 0) * bands)]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("th"), pa.array(d1.view(np.int64)), pa.array(d2.view(np.int64)), pa.array(size), pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))],
                ["id", "th", "d1", "d2", "grams", "bands"],
            )

    return run


def _meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(band hash, a, b): within a batch a is the least node with the hash; rows whose b is not a carry a hash of their own."""
    for batch in batches:
        if not batch.num_rows:
            continue
        lists = batch.column("bands")
        flat = lists.flatten().to_numpy().view(np.uint64)
        node = np.repeat(batch.column("node").to_numpy(), lists.value_lengths().to_numpy())
        order = np.lexsort((node, flat))
        flat, node = flat[order], node[order]
        new = np.ones(len(flat), dtype=bool)
        new[1:] = flat[1:] != flat[:-1]
        least = node[np.flatnonzero(new)][np.cumsum(new) - 1]
        linked = np.unique(np.stack([least[~new], node[~new]]), axis=1) if (~new).any() else np.zeros((2, 0), np.int64)
        own = mix(mix(linked[0].view(np.uint64)) + linked[1].view(np.uint64))
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate([flat[new], own]).view(np.int64)), pa.array(np.concatenate([least[new], linked[0]])), pa.array(np.concatenate([node[new], linked[1]]))],
            ["h", "a", "b"],
        )


def _verify(n: int, similarity: Fraction):
    p, q = similarity.numerator, similarity.denominator

    def block_pair(table: pa.Table) -> pa.RecordBatch:
        node, block, copies = (table.column(c).to_numpy() for c in ("node", "block", "copies"))
        row, name = _grams(pa.concat_arrays(table.column("text").chunks), n)
        size = np.bincount(row, minlength=len(node)).astype(np.int64)
        names, column, held = np.unique(name, return_inverse=True, return_counts=True)
        shared = held > 1
        keep = shared[column]
        row, column = row[keep], (np.cumsum(shared) - 1)[column[keep]]
        common = np.zeros((len(node), len(node)), np.float32)
        width = max(1, min((16 << 20) // len(node), int(shared.sum())))
        order = np.argsort(column, kind="stable")
        row, column = row[order], column[order]
        for low in range(0, int(shared.sum()), width):  # counts below 2^24 are exact
            a, b = np.searchsorted(column, (low, low + width))
            x = np.zeros((len(node), width), np.float32)
            x[row[a:b], column[a:b] - low] = 1
            common += x @ x.T
        inter = common.astype(np.int64)
        link = ((p + q) * inter >= p * (size[:, None] + size[None, :])) & (inter > 0)
        np.fill_diagonal(link, False)
        if table.column("cross")[0].as_py():
            link &= block[:, None] != block[None, :]
        count = link @ copies
        has = np.flatnonzero(count)
        by_rank = np.argsort(node, kind="stable")  # a component takes its least node
        label = np.empty(len(node), np.int64)
        label[by_rank] = np.arange(len(node))
        while True:
            new = np.minimum(label, np.where(link, label[None, :], len(node)).min(axis=1))
            new = np.minimum(new, new[by_rank[new]])
            if (new == label).all():
                break
            label = new
        least = node[by_rank[label]]
        return pa.RecordBatch.from_arrays([pa.array(node[has]), pa.array(count[has].astype(np.int64)), pa.array(least[has])], ["node", "links", "hub"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in grouped(batches, "task"):
            yield block_pair(table)

    return run


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, similarity: Fraction = SIMILARITY, recall: float = RECALL
) -> DataFrame:
    """One row per row of ``docs``: (id, class_id, n_links).

    Two texts are linked if the Jaccard similarity of their sets of word n-grams (words of any case, as they
    are; a text of under n words is one n-gram) is at least ``similarity``; n_links counts the other rows linked,
    exact copies and repeated rows included.  class_id is the least id of all documents connected by links.  A text without
    words (null or empty) has no links and is its own class.  A null id is not compared: class_id null,
    no links.  Rows of equal id but different texts are versions of one document: each has its own links, and they share a
    class.  Ids are integers.  An empty table gives an empty result; other columns are ignored.  Words and n-grams are
    compared by 64-bit hashes, sets of n-grams that are equal by 128-bit digests.
    """
    spark = docs.sparkSession
    kind = docs.schema[id_col].dataType.simpleString()
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    base = docs.select(F.col(id_col).alias("id"), text.alias("text"), F.xxhash64(text).alias("th"))
    bands, rows = choose_bands(float(similarity), recall)
    signed = materialize(base.mapInArrow(_signatures(words, bands, rows), f"id {kind}, th long, d1 long, d2 long, grams long, bands array<long>"))
    compared = signed.filter("grams > 0 AND id IS NOT NULL")
    # a class of equal sets has a node of its own; the text of one of its rows stands for all
    classes = materialize(
        compared.groupBy("d1", "d2", "grams")
        .agg(F.min(F.struct(F.col("id").cast("long").alias("id"), "th")).alias("head"), F.count(F.lit(1)).alias("copies"), F.first("bands").alias("bands"))
        .withColumn("node", F.monotonically_increasing_id())
    )
    met = classes.select("node", "bands").mapInArrow(_meet, "h long, a long, b long")
    # a batch sends a hash once, so a window holds at most a row for each batch
    stars = met.select(F.min("a").over(Window.partitionBy("h")).alias("a"), "b")
    candidates = materialize(connected_components(stars).join(classes.select("node", "copies", "grams", "head"), "node"))
    sizes = materialize(
        candidates.groupBy("component")
        .agg(F.count(F.lit(1)).alias("texts"), F.sum("grams").alias("grams"))
        .select("component", F.greatest(F.ceil(F.col("texts") / BLOCK_TEXTS), F.ceil(F.col("grams") / BLOCK_GRAMS), F.lit(1)).cast("int").alias("blocks"))
    )
    dealt = candidates.select("node", "component", "copies", "head").join(sizes, "component").withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    # repeated rows of the head meet it too; one of them goes on, combined where they were joined
    members = (
        dealt.join(base, (F.col("head.id") == F.col("id").cast("long")) & (F.col("head.th") == F.col("th")))
        .groupBy("node", "component", "copies", "blocks", "block")
        .agg(F.first("text").alias("text"))
    )
    # every pair of blocks once; a block alone where there is only one
    tasks = members.select("*", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")).withColumn(
        "task", F.xxhash64("component", F.least("block", "other"), F.greatest("block", "other"))
    ).withColumn("cross", F.expr("block <> other"))
    verified = materialize(
        tasks.select("task", "node", "block", "cross", "copies", "text")
        .repartition(shuffle_partitions(spark), "task")
        .sortWithinPartitions("task")
        .mapInArrow(_verify(words, similarity), "node long, links long, hub long")
    )
    # versions of one document share a class
    digest = ["d1", "d2", "grams"]
    several = compared.groupBy("id").agg(F.min(F.struct(*digest)).alias("low"), F.max(F.struct(*digest)).alias("high")).filter("low <> high").select("id")
    versions = materialize(compared.select("id", *digest).join(several, "id").distinct().join(classes.select(*digest, "node"), digest).select("id", "node"))
    same = versions.join(versions.groupBy("id").agg(F.min("node").alias("b")), "id").select(F.col("node").alias("a"), "b")
    joined = materialize(connected_components(verified.select(F.col("node").alias("a"), F.col("hub").alias("b")).unionByName(same)))
    least = joined.join(classes.select("node", "head"), "node").groupBy("component").agg(F.min("head.id").alias("class"))
    links = verified.groupBy("node").agg(F.sum("links").alias("links"))
    found = materialize(
        classes.select(*digest, "node", "copies", F.col("head.id").alias("first"))
        .join(links, "node", "left")
        .join(joined.join(least, "component").select("node", "class"), "node", "left")
        .select(*digest, F.coalesce("class", "first").alias("class"), (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("links"))
    )
    return (
        signed.select("id", "d1", "d2", "grams", F.col("id").isNotNull().alias("named"))
        .join(found.withColumn("named", F.lit(True)), ["d1", "d2", "grams", "named"], "left")
        .select(
            F.col("id").alias(id_col),
            F.coalesce("class", F.col("id").cast("long")).cast(kind).alias("class_id"),
            F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
        )
    )
