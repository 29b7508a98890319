"""Removal of repeated passages by hashes of fixed windows of words, dealt by prefix classes.

A suffix is a word position with SPAN words to come; only its first SPAN words matter.  No suffix tree is built: the repeats asked
for are the unions of equal windows of SPAN words, so windows are hashed, sorted by hash and compared with their neighbours
(there is no lexical order and no LCP value; see the README).

1. *Prune.*  Every window of SPAN words is represented by the least hash of its SEED-word runs (a minimizer).  Two equal
   windows share it at two different places, so a window whose minimizer value stands at one place in
   the corpus cannot be repeated.  Values that stand at two or more places are counted by a shuffle of about
   one value in seven positions and kept in a bit table of bounded size (false positives cost work, not results).
2. *Deal.*  The remaining suffixes go to groups by a prefix of variable length: 5 words; 10 where the 5-word
   class holds more than its share of all suffixes; all SPAN words where that is still too much.  Equal windows of one
   slice of documents are merged before the shuffle, so a passage in a third of all documents sends one suffix per slice.
3. *Mark.*  A group's suffixes are sorted by hash (by Spark, spilling) and read as a stream: neighbours of equal hash are one repeated
   window; its least place is the first occurrence and all others are marked.  A stream holds one batch, whatever the group's size.
4. *Remove.*  Marked spans meet their document and are cut out.

Suffixes are named by two 64-bit hashes, of their first and their last ten words; equal names are not compared word by word.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize, shuffle_partitions
from .words import Names, Words, hash_words, mix, slices, slide, split_words

SPAN, SEED = 20, 8
#: prefix lengths that a group may have, before all SPAN words
PREFIXES = (5, 10)
#: a bit table of so many bits for each repeated value, and at most so many bits (32 MB)
BITS_EACH, MAX_BITS = 16, 1 << 28
_PAGE = 1 << 20
#: no document id stands before all others
_NO_ID = -(1 << 63)


def _u64(a: np.ndarray) -> pa.Array:
    return pa.array(a.view(np.int64))


class _Windows:
    """Windows of a slice: ``at`` their first words, ``least`` their minimizer values."""

    def __init__(self, words: Words):
        hashes = hash_words(words.words)[words.codes] if len(words.codes) else np.zeros(0, np.uint64)
        self.names, n = Names(hashes), len(hashes)
        starts = np.arange(max(n - SPAN + 1, 0))
        ends = np.repeat(words.starts[1:], np.diff(words.starts))  # of each word's document
        whole = ends[: len(starts)] - starts >= SPAN
        self.at = starts[whole]
        seeds = self.names.of(np.arange(max(n - SEED + 1, 0)), SEED)
        width = SPAN - SEED + 1
        least = slide(np.minimum, seeds, width) if len(starts) else seeds[:0]
        self.least = least[whole]
        # places that are the minimizer of some window
        reach = np.zeros(len(seeds) + width - 1, dtype=np.uint64)
        reach[width - 1 : width - 1 + len(least)] = np.where(whole, least, 0)
        self.places = seeds[slide(np.maximum, reach, width) == seeds] if len(starts) else seeds[:0]

    def prefix(self, at: np.ndarray, words: int, bits: int) -> np.ndarray:
        return (self.names.of(at, words) >> np.uint64(64 - bits)).astype(np.int64)


def _survey(bits: int):
    """Minimizer values with their places (kind 0) and prefix classes with their suffixes (kind: prefix length)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            w = _Windows(split_words(batch.column("text")))
            keys, counts = np.unique(w.places, return_counts=True)
            parts = [(0, keys.view(np.int64), counts)]
            for words in PREFIXES:
                found = np.bincount(w.prefix(w.at, words, bits))
                parts.append((words, np.flatnonzero(found), found[found > 0]))
            for kind, key, n in parts:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(key), kind, np.int32)), pa.array(key.astype(np.int64)), pa.array(n.astype(np.int64))], ["kind", "key", "n"]
                )

    return run


def _pages(mask: int):
    """One page of the bit table from the values that fall in it."""

    def run(frame):
        import pandas as pd

        slots = frame["key"].to_numpy().view(np.uint64) & np.uint64(mask)
        bits = np.zeros(min(_PAGE, mask + 1), dtype=np.uint8)
        bits[(slots % np.uint64(_PAGE)).astype(np.int64)] = 1
        return pd.DataFrame({"page": [int(frame["page"].iloc[0])], "bits": [np.packbits(bits).tobytes()]})

    return run


def _emit(table, mask: int, bits: int, crowded):
    """Suffixes that may be repeated, the first of equal ones in a slice; the others at once as marked spans (length > 0)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bit_table = np.frombuffer(table.value, np.uint8)
        for batch in slices(batches, "text"):
            doc, dig = (batch.column(c).to_numpy() for c in ("doc", "dig"))
            order = np.lexsort((dig, doc))
            doc, dig = doc[order], dig[order]
            words = split_words(batch.column("text").take(pa.array(order)))
            w = _Windows(words)
            slot = (w.least & np.uint64(mask)).astype(np.int64)
            at = w.at[(bit_table[slot >> 3] >> (7 - (slot & 7)).astype(np.uint8)) & 1 == 1]
            if not len(at):
                continue
            head, tail = w.names.of(at, 10), w.names.of(at + 10, SPAN - 10)
            _, first, which = np.unique(mix(head) ^ tail, return_index=True, return_inverse=True)
            first = first[which]
            again = (first != np.arange(len(at))) & (head[first] == head) & (tail[first] == tail)
            rows = words.rows()
            row, place = rows[at], at - words.starts[rows[at]]
            copy = again & (doc[row] == doc[row[first]]) & (dig[row] == dig[row[first]]) & (place == place[first])  # a repeated row
            at, head, tail, again = at[~copy], head[~copy], tail[~copy], again[~copy]
            # the group of a suffix: its class by the shortest prefix that is not crowded
            route = mix(w.names.of(at, SPAN))
            for i in range(len(PREFIXES) - 1, -1, -1):
                cls = w.prefix(at, PREFIXES[i], bits)
                route = np.where(crowded[i][cls], route, mix((cls * len(PREFIXES) + i).astype(np.uint64)))
            one = ~again
            route >>= np.uint64(62 - bits)  # a few for each prefix class
            yield _rows(route[one], head[one], tail[one], doc, dig, rows[at[one]], at[one] - words.starts[rows[at[one]]], 0)
            if again.any():
                a = at[again]
                new = np.ones(len(a), dtype=bool)  # begins a run of neighbouring windows
                new[1:] = (a[1:] != a[:-1] + 1) | (rows[a[1:]] != rows[a[:-1]])
                begin, end = a[new], a[np.append(np.flatnonzero(new)[1:] - 1, len(a) - 1)] + SPAN
                zero = np.zeros(len(begin), np.uint64)
                yield _rows(mix(begin.astype(np.uint64) + dig.view(np.uint64)[rows[begin]]) >> np.uint64(62 - bits), zero, zero, doc, dig, rows[begin], begin - words.starts[rows[begin]], end - begin)

    return run


# what changes from row to row stands together, which the shuffle's compression favours; place: at * 2^24 + route
_EMITTED = "doc long, dig long, length int, place long, head long, tail long"
_ROUTE_BITS = 24


def _rows(route, head, tail, doc, dig, row, at, length) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [
            pa.array(doc[row]),
            pa.array(dig[row]),
            pa.array(np.broadcast_to(np.asarray(length, np.int32), (len(at),)).astype(np.int32)),
            pa.array((at.astype(np.int64) << _ROUTE_BITS) + route.astype(np.int64)),
            _u64(head),
            _u64(tail),
        ],
        ["doc", "dig", "length", "place", "head", "tail"],
    )


def _subtrees(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Leaves but the least of every internal node of depth SPAN; marked spans pass.  A span is begin * 2^32 + end."""
    node, least = None, None  # the open node and its least leaf
    for batch in batches:
        if not batch.num_rows:
            continue
        head, tail, length, doc, dig, at = (batch.column(c).to_numpy() for c in ("head", "tail", "length", "doc", "dig", "place"))
        same = np.zeros(len(head), dtype=bool)
        same[1:] = (head[1:] == head[:-1]) & (tail[1:] == tail[:-1]) & (length[1:] == 0) & (length[:-1] == 0)
        same[0] = node == (head[0], tail[0]) and length[0] == 0
        begin = np.maximum.accumulate(np.where(same, 0, np.arange(len(same))))
        first = [np.where(same & (begin == 0) & same[0], least[k], x[begin]) if same[0] else x[begin] for k, x in enumerate((doc, dig, at))]
        copy = (doc == first[0]) & (dig == first[1]) & (at == first[2])  # the least leaf again, from a repeated row
        node, least = (head[-1], tail[-1]) if length[-1] == 0 else None, [x[-1] for x in first]
        marked = (same & ~copy) | (length > 0)
        out = batch.filter(pa.array(marked)).select(["doc", "dig", "place"])
        at = at[marked] >> _ROUTE_BITS
        yield out.set_column(2, "span", pa.array((at << 32) + at + np.where(length[marked] > 0, length[marked], SPAN)))


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts without their marked spans, words joined by one space."""
    for batch in slices(batches, "text"):
        words = split_words(batch.column("text"), coded=False)
        n, rows = len(words.begin), words.rows()
        spans = batch.column("spans")
        depth = np.zeros(n + 1, dtype=np.int64)
        for i in np.flatnonzero(spans.is_valid().to_numpy(zero_copy_only=False)):
            flat = spans[int(i)].values.to_numpy()
            size = words.starts[i + 1] - words.starts[i] + 1
            here = depth[words.starts[i] : words.starts[i + 1] + 1]
            here += np.bincount(flat >> 32, minlength=size) - np.bincount(flat & 0xFFFFFFFF, minlength=size)
        keep = np.cumsum(depth[:-1]) == 0
        # kept words with a space after each but the last of a row: +1 where such a run of bytes begins, -1 where it ends
        kept_rows = rows[keep]
        begin, end = words.begin[keep], words.end[keep] + 1
        if len(kept_rows):
            end[np.append(kept_rows[1:] != kept_rows[:-1], True)] -= 1
        edge = np.zeros(len(words.data) + 1, dtype=np.int8)
        edge[begin] += 1
        edge -= np.bincount(end, minlength=len(edge)).astype(np.int8)
        body = words.data[np.cumsum(edge[:-1], dtype=np.int8) > 0]
        offsets = np.concatenate([[0], np.cumsum(np.bincount(kept_rows, end - begin, len(batch))).astype(np.int64)])
        text = pa.Array.from_buffers(pa.large_string(), len(batch), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(body))])
        total = np.diff(words.starts)
        removed = np.bincount(rows, ~keep, len(batch)).astype(np.int64)
        yield pa.RecordBatch.from_arrays(
            [batch.column("id"), pa.array(total.astype(np.int64)), pa.array(removed), text.cast(pa.string())], ["id", "n_words", "n_removed", "text"]
        )


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Whole texts without repeated passages: (id, n_words, n_removed, text), the kept words joined by one space.

    A word goes if a window of 20 words that covers it begins earlier too: in a document of smaller id,
    or earlier in the same one.  Null ids come before all others; a null text has no words.  Rows of one id are
    ordered by a hash of their text; rows of equal id and text are one document and get the same result.  Texts of under 20
    words stay as they are.  Ids are integers.  An empty table gives an empty result; other columns are ignored.
    """
    spark = docs.sparkSession
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    base = docs.select(
        F.col(id_col).alias("id"), F.coalesce(F.col(id_col).cast("long"), F.lit(_NO_ID)).alias("doc"), F.xxhash64(text).alias("dig"), text.alias("text")
    )
    parts = shuffle_partitions(spark)
    bits = min(max(12, (8 * parts).bit_length()), _ROUTE_BITS - 2)
    survey = materialize(
        base.select("text").mapInArrow(_survey(bits), "kind int, key long, n long").groupBy("kind", "key").agg(F.sum("n").alias("n")).filter("kind > 0 OR n > 1")
    )
    classes = survey.filter("kind > 0").collect()  # at most two for each of 2^bits prefix classes
    total = sum(r["n"] for r in classes if r["kind"] == PREFIXES[0])
    crowded = np.zeros((len(PREFIXES), 1 << bits), dtype=bool)
    for r in classes:
        crowded[PREFIXES.index(r["kind"]), r["key"]] = r["n"] > max(total >> 10, 1)
    repeated = survey.filter("kind = 0").select("key")
    mask = min(MAX_BITS, 1 << max(16, (BITS_EACH * repeated.count()).bit_length())) - 1
    page = F.shiftright(F.col("key").bitwiseAND(mask), 20)
    pages = repeated.withColumn("page", page).groupBy("page").applyInPandas(_pages(mask), "page long, bits binary").collect()  # 32 MB at most
    bit_table = bytearray((mask + 1) // 8)
    for r in pages:
        bit_table[r["page"] * (_PAGE // 8) : r["page"] * (_PAGE // 8) + len(r["bits"])] = r["bits"]
    table = spark.sparkContext.broadcast(bytes(bit_table))
    spans = (
        base.select("doc", "dig", "text")
        .mapInArrow(_emit(table, mask, bits, crowded), _EMITTED)
        .repartition(parts, F.col("place").bitwiseAND((1 << _ROUTE_BITS) - 1))
        .sortWithinPartitions("head", "tail", "length", "doc", "dig", "place")
        .mapInArrow(_subtrees, "doc long, dig long, span long")
        .groupBy("doc", "dig")
        .agg(F.collect_list("span").alias("spans"))  # at most one span for each word of the document
    )
    return base.join(spans, ["doc", "dig"], "left").select("id", "text", "spans").mapInArrow(
        _cut, f"id {docs.schema[id_col].dataType.simpleString()}, n_words long, n_removed long, text string"
    ).withColumnRenamed("id", id_col)
