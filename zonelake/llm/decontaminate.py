"""Benchmark decontamination by greedy string tiling.

1. *Seeds.*  Documents and benchmark items are sequences of normalised words (letters and digits, lower case), each hashed once.  A
   pair that shares a run of SEED words (of all words of a shorter item) is a candidate.  A benchmark within MAX_SEEDS runs is broadcast as an index
   and documents are judged in one pass without a shuffle; a larger one is joined on seed hashes.
2. *Tiles.*  Of a candidate's document only the words under shared seeds are looked at: no tile lies elsewhere.  The longest
   common runs of unmarked words are marked, longest first, until none as long as a seed is left.  The length of the longest run is found by bisection over Karp-Rabin hashes of all unmarked windows.
3. *Threshold.*  The item counts as leaked if its tiles cover at least COVERAGE of its words, in whatever order they
   stand in the document.

Words are compared by 64-bit hashes; what is found is not compared letter by letter.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .words import Names, hash_words, slices, split_words

#: words of a seed and of the shortest tile (all words of an item that has fewer), and the share of an item that tiles must cover
SEED, COVERAGE = 5, 0.5
#: item words whose index is broadcast (about 60 bytes each)
MAX_SEEDS = 1_000_000

_DROP = re.compile(r"[\W_]+")


def _normal(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(word hashes, starts of the rows) of the normalised words; words of punctuation alone vanish."""
    words = split_words(texts)
    plain = [_DROP.sub("", w.decode("utf-8", "replace").lower()).encode() for w in words.words]
    hashes = hash_words(plain) if plain else np.zeros(0, np.uint64)
    real = np.array([bool(w) for w in plain], dtype=bool)[words.codes] if len(words.codes) else np.zeros(0, bool)
    return hashes[words.codes[real]] if len(words.codes) else hashes, np.concatenate([[0], np.cumsum(real)])[words.starts]


def _seeds(hashes: np.ndarray, starts: np.ndarray, length: int = SEED):
    """(row, name, place) of every run of ``length`` words."""
    at = np.arange(max(len(hashes) - length + 1, 0))
    ends = np.repeat(starts[1:], np.diff(starts))
    at = at[ends[: len(at)] - at >= length]
    return np.repeat(np.arange(len(starts) - 1), np.diff(starts))[at], Names(hashes).of(at, length), at


def _item_seeds(hashes: np.ndarray, starts: np.ndarray) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """{length: (row, name)} of the items' seeds: an item of fewer than SEED words is one seed."""
    size = np.diff(starts)
    out = {}
    for length in np.unique(np.minimum(size[size > 0], SEED)).tolist():
        row, name, _ = _seeds(hashes, starts, length)
        own = np.minimum(size[row], SEED) == length
        out[length] = row[own], name[own]
    return out


def _under(doc: np.ndarray, at: np.ndarray, length: int) -> np.ndarray:
    """The words of ``doc`` under seeds at ``at``; where others lie between, a value that is no word's."""
    places = np.unique(at[:, None] + np.arange(length))
    gap = np.flatnonzero(np.diff(places) > 1) + 1
    return np.insert(doc[places], gap, np.arange(len(gap), dtype=np.uint64))


def tile(doc: np.ndarray, item: np.ndarray, least: int = SEED) -> tuple[int, int]:
    """(words of the item covered, tiles) by greedy string tiling of two hash sequences."""
    names = Names(doc), Names(item)
    free = [np.ones(len(doc), bool), np.ones(len(item), bool)]
    covered = tiles = 0

    def windows(side: int, length: int) -> np.ndarray:
        """Starts of the unmarked windows."""
        marked = np.concatenate([[0], np.cumsum(~free[side])])
        return np.flatnonzero(marked[length:] == marked[:-length]) if len(marked) > length else np.zeros(0, np.int64)

    def common(length: int):
        at = windows(0, length), windows(1, length)
        both = names[0].of(at[0], length), names[1].of(at[1], length)
        return at, both, np.isin(both[1], both[0])

    most = len(item)
    while True:
        low, high = least - 1, most  # low is reached, everything above high is not
        while low < high:
            mid = (low + high + 1) // 2
            if common(mid)[2].any():
                low = mid
            else:
                high = mid - 1
        if low < least:
            return covered, tiles
        most = low
        (doc_at, item_at), (doc_names, item_names), hit = common(low)
        places: dict[int, list[int]] = {}
        wanted = np.isin(doc_names, item_names[hit])
        for name, at in zip(doc_names[wanted].tolist(), doc_at[wanted].tolist()):
            places.setdefault(name, []).append(at)
        for name, at in zip(item_names[hit].tolist(), item_at[hit].tolist()):
            if not free[1][at : at + low].all():
                continue
            for there in places[name]:
                if free[0][there : there + low].all():
                    free[0][there : there + low] = free[1][at : at + low] = False
                    covered, tiles = covered + low, tiles + 1
                    break


def _judge(doc: np.ndarray, item: np.ndarray, coverage: float):
    covered, tiles = tile(doc, item, min(SEED, len(item)))
    return (len(item), covered, tiles) if covered >= coverage * len(item) and covered else None


def _index(benchmark: pa.Table) -> dict:
    """By seed length: sorted seed names with their items and a table of the names' low bits to skip by; the items' words."""
    hashes, starts = _normal(benchmark.column("text").combine_chunks().cast(pa.large_string()) if benchmark.num_rows else pa.array([], pa.large_string()))
    seeds = {}
    for length, (row, name) in _item_seeds(hashes, starts).items():
        order = np.lexsort((row, name))
        low = np.zeros(1 << 22, dtype=bool)
        low[(name & np.uint64(len(low) - 1)).astype(np.int64)] = True
        seeds[length] = name[order], row[order], low
    return {"seeds": seeds, "hashes": hashes, "starts": starts}


def _leaks_of(batch: pa.RecordBatch, index: dict, coverage: float):
    """(row of the batch, item, item words, covered, tiles) of the leaks in a batch."""
    hashes, starts = _normal(batch.column("text"))
    out = []
    for length, (names, rows, low) in index["seeds"].items():
        row, name, at = _seeds(hashes, starts, length)
        maybe = low[(name & np.uint64(len(low) - 1)).astype(np.int64)]
        row, name, at = row[maybe], name[maybe], at[maybe]
        first, last = (np.searchsorted(names, name, side) for side in ("left", "right"))
        n = last - first
        if not n.sum():
            continue
        items = rows[np.repeat(first - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())]
        row, at = np.repeat(row, n), np.repeat(at, n)
        order = np.lexsort((at, items, row))
        row, items, at = row[order], items[order], at[order]
        new = np.append(np.flatnonzero(np.append(True, (row[1:] != row[:-1]) | (items[1:] != items[:-1]))), len(row)).tolist()
        for a, b in zip(new, new[1:]):
            i = items[a]
            found = _judge(_under(hashes, at[a:b], length), index["hashes"][index["starts"][i] : index["starts"][i + 1]], coverage)
            if found:
                out.append((int(row[a]), int(i), *found))
    return sorted(out)


def _small(benchmark: DataFrame) -> bool:
    """Whether the whole benchmark is within the broadcast bound (by its bytes; a word has one at least)."""
    return (benchmark.agg(F.sum(F.octet_length("text"))).first()[0] or 0) <= 4 * MAX_SEEDS


def _broadcast_index(items: DataFrame):
    table = items.orderBy("item").toArrow()
    return items.sparkSession.sparkContext.broadcast(_index(table)), table.column("item").to_pylist()


def _items(benchmark: DataFrame, item_col: str, text_col: str) -> DataFrame:
    return benchmark.select(F.col(item_col).cast("long").alias("item"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))


def find_leaks(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", coverage: float = COVERAGE
) -> DataFrame:
    """The leaks only: (id, item id, n_item_words, n_covered, n_tiles), a row for each document row and item.

    Null texts are empty and leak nothing; an item of under 5 words leaks where all of them stand side by side; null ids are
    reported as they are; repeated rows of either table give repeated leaks; empty tables give none.  Other columns are ignored.
    """
    items = _items(benchmark, item_col, text_col)
    kind = docs.schema[id_col].dataType.simpleString()
    base = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    if _small(items):
        index, ids = _broadcast_index(items)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in slices(batches, "text"):
                found = _leaks_of(batch, index.value, coverage)
                if found:
                    row, item, n, covered, tiles = (list(x) for x in zip(*found))
                    yield pa.RecordBatch.from_arrays(
                        [batch.column("id").take(pa.array(row)), pa.array([ids[i] for i in item], pa.int64()), *(pa.array(x, pa.int64()) for x in (n, covered, tiles))],
                        ["id", "item", "n_item_words", "n_covered", "n_tiles"],
                    )

        leaks = base.mapInArrow(run, f"id {kind}, item long, n_item_words long, n_covered long, n_tiles long")
    else:
        leaks = _leaks_by_join(base, items, coverage, kind)
    return leaks.withColumnsRenamed({"id": id_col, "item": item_col})


def _exploded(frame: DataFrame, id_kind: str, lengths: list[int] | None = None) -> DataFrame:
    """(seed, id, dig) with each row's distinct seeds of ``lengths`` (None: an item's own); ``dig`` tells texts of equal id apart."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            hashes, starts = _normal(batch.column("text"))
            seeds = [_seeds(hashes, starts, length)[:2] for length in lengths] if lengths is not None else list(_item_seeds(hashes, starts).values())
            for row, name in seeds:
                row, name = np.unique(np.stack([row.astype(np.uint64), name]), axis=1)
                row = pa.array(row.astype(np.int64))
                yield pa.RecordBatch.from_arrays([pa.array(name.view(np.int64)), batch.column("id").take(row), batch.column("dig").take(row)], ["seed", "id", "dig"])

    return frame.mapInArrow(run, f"seed long, id {id_kind}, dig long")


def _seed_lengths(items: DataFrame) -> list[int]:
    """The seed lengths of a benchmark: SEED and fewer."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            size = np.diff(_normal(batch.column("text"))[1])
            yield pa.RecordBatch.from_pydict({"length": pa.array(np.unique(np.minimum(size[size > 0], SEED)).astype(np.int64))})

    return sorted(r[0] for r in items.select("text").mapInArrow(run, "length long").distinct().collect())


def _leaks_by_join(base: DataFrame, items: DataFrame, coverage: float, kind: str) -> DataFrame:
    """Leaks of a benchmark of any size: pairs meet on seeds (both sides plain shuffles, so AQE splits a seed that very many
    documents hold), then each pair fetches its two texts."""
    docs = base.withColumn("dig", F.xxhash64("text"))
    marked = items.withColumnRenamed("item", "id").withColumn("dig", F.xxhash64("text"))
    theirs = _exploded(marked, "long").withColumnsRenamed({"id": "item", "dig": "item_dig"})
    pairs = materialize(_exploded(docs, kind, _seed_lengths(items)).join(theirs, "seed").select("id", "dig", "item", "item_dig").distinct())
    withheld = marked.withColumnsRenamed({"id": "item", "dig": "item_dig", "text": "item_text"})
    same = lambda a, b, x, y: a[x].eqNullSafe(b[x]) & (a[y] == b[y])
    with_item = pairs.join(withheld, same(pairs, withheld, "item", "item_dig")).select(pairs["*"], "item_text")
    both = with_item.join(docs, same(with_item, docs, "id", "dig")).select(docs["id"], docs["text"], with_item["item"], with_item["item_text"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            hashes, starts = _normal(batch.column("text"))
            others, other_starts = _normal(batch.column("item_text"))
            found = []
            for r in range(len(batch)):
                doc, item = hashes[starts[r] : starts[r + 1]], others[other_starts[r] : other_starts[r + 1]]
                length = min(SEED, len(item))
                ends = np.array([0, len(doc)]), np.array([0, len(item)])
                _, name, at = _seeds(doc, ends[0], length)
                judged = _judge(_under(doc, at[np.isin(name, _seeds(item, ends[1], length)[1])], length), item, coverage)
                if judged:
                    found.append((r, *judged))
            if found:
                row, n, covered, tiles = (list(x) for x in zip(*found))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id").take(pa.array(row)), batch.column("item").take(pa.array(row)), *(pa.array(x, pa.int64()) for x in (n, covered, tiles))],
                    ["id", "item", "n_item_words", "n_covered", "n_tiles"],
                )

    return both.mapInArrow(run, f"id {kind}, item long, n_item_words long, n_covered long, n_tiles long")


def drop_leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", coverage: float = COVERAGE) -> DataFrame:
    """The rows of ``docs``, with all their columns, in which no item leaks (see ``find_leaks``).  Ids don't matter here: with a benchmark
    that is too large to broadcast, rows are matched by 128 bits of their text's hash."""
    items = _items(benchmark, item_col, text_col)
    if not _small(items):
        # a text leaks whatever its id: rows are found by 128 bits of their text
        text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
        key = F.struct(F.xxhash64(F.lit(1), text), F.xxhash64(F.lit(2), text))
        found = find_leaks(docs.select(F.to_json(key).alias("_key"), F.col(text_col)), benchmark, "_key", text_col, item_col, coverage)
        return docs.join(found.select(F.col("_key").alias("_gone")).distinct(), F.to_json(key) == F.col("_gone"), "left_anti")
    index, _ = _broadcast_index(items)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text_col):
            keep = np.ones(len(batch), dtype=bool)
            renamed = pa.RecordBatch.from_arrays([batch.column(text_col)], ["text"])
            for r, *_ in _leaks_of(renamed, index.value, coverage):
                keep[r] = False
            yield batch.filter(pa.array(keep))

    return docs.mapInArrow(run, docs.schema)
