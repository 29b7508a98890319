"""Document fingerprints: digests of statistically improbable features (after Roussev 2010, "Data fingerprinting with similarity digests").

1. The Shannon entropy of every window of 32 bytes, on a scale of 0 to 1000, is counted over all documents: a window is the rarer,
   the fewer windows of the corpus have its entropy.  Windows of almost no entropy (runs of one character) come last.
2. Every 32 neighbouring windows vote for the rarest of them; windows with 8 votes or more are the features of a text.
3. The features go, in order, into a chain of Bloom filters of 2048 bits, 160 features each, 5 hashes of 11 bits a feature.
4. Two chains are compared by the overlap of set bits, from what chance gives (0) to all that the smaller filter has (1): the mean,
   weighted by features, of each filter's best partner, for the chain of fewer features.
"""

from __future__ import annotations

import base64
import bisect
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import shuffle_partitions
from .words import binary, mix, slices, slide

#: bytes of a window, windows that vote together, votes of a feature
WINDOW, VOTERS, VOTES = 32, 32, 8
#: entropies are told apart in LEVELS steps; below WEAK of them a window is chosen only where there is nothing else
LEVELS, WEAK = 1000, 100
FILTER_BITS, FILTER_FEATURES, HASHES, HASH_BITS = 2048, 160, 5, 11
#: normalised overlap of two filters that counts as chance
NOISE = 0.1
#: windows worked on at once; rows of a filter comparison; copies written as one row
CHUNK, BLOCK, COPIES = 1 << 16, 512, 65_536

_UNIT = 1 << 20
#: c * log2(c) in units, so that running sums are exact
_TERM = np.array([0] + [round(c * np.log2(c) * _UNIT) for c in range(1, WINDOW + 1)], dtype=np.int64)
_FULL = int(_TERM[WINDOW])
_GAIN = np.diff(_TERM).astype(np.int32)


def entropy_levels(data: np.ndarray) -> np.ndarray:
    """The entropy, 0 to LEVELS, of the window that starts at each byte (as many as fit) of up to 2^22 bytes."""
    n = len(data)
    if n < WINDOW:
        return np.zeros(0, np.int16)
    # equal bytes of a window, before and after each position: neighbours in the order (byte, position)
    order = np.argsort(data, kind="stable").astype(np.int32)
    key = order + data[order].astype(np.int32) * np.int32(n + WINDOW)
    before, after = np.zeros(n, np.uint8), np.zeros(n, np.uint8)
    for k in range(1, min(WINDOW, n)):
        near = key[k:] - key[:-k] < WINDOW
        if not near.any():
            break
        before[k:] += near
        after[:-k] += near
    enter, leave = np.empty(n, np.int32), np.empty(n, np.int32)
    enter[order], leave[order] = _GAIN[before], _GAIN[after]
    total = np.empty(n - WINDOW + 1, np.int64)
    total[0] = _TERM[np.bincount(data[:WINDOW], minlength=256)].sum()
    total[1:] = enter[WINDOW:] - leave[: n - WINDOW]
    return ((_FULL - np.cumsum(total)) * LEVELS // _FULL).astype(np.int16)


def _windows(offsets: np.ndarray) -> np.ndarray:
    """Whether a window that lies within one text starts at each byte."""
    inside = np.ones(int(offsets[-1]), dtype=bool)
    for end in offsets[1:].tolist():
        inside[max(end - WINDOW + 1, 0) : end] = False
    return inside


def rarity(docs: DataFrame, text_col: str = "text") -> np.ndarray:
    """The place of each entropy level (0: the rarest), from all windows of all texts."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros(LEVELS + 1, np.int64)
        for batch in slices(batches, "text"):
            data, offsets = binary(batch.column("text"))
            inside = _windows(offsets)
            for a in range(0, len(data), CHUNK):
                levels = entropy_levels(data[a : a + CHUNK + WINDOW - 1])
                held += np.bincount(levels[inside[a : a + len(levels)]], minlength=LEVELS + 1)
        yield pa.RecordBatch.from_pydict({"level": pa.array(np.arange(LEVELS + 1)), "n": pa.array(held)})

    seen = docs.select(F.col(text_col).cast("string").alias("text")).mapInArrow(count, "level long, n long").groupBy("level").agg(F.sum("n").alias("n"))
    return ranks({r["level"]: r["n"] for r in seen.collect()})  # LEVELS + 1 rows


def ranks(counts: dict[int, int]) -> np.ndarray:
    out = np.empty(LEVELS + 1, np.int64)
    out[sorted(range(LEVELS + 1), key=lambda level: (level < WEAK, counts.get(level, 0), level))] = np.arange(LEVELS + 1)
    return out


def _features(data: np.ndarray, offsets: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(text, hash) of the features of all texts, in their order; a repeated feature of a text counts once."""
    inside = _windows(offsets)
    held = []
    last = np.int64(1) << 62
    for a in range(0, len(data), CHUNK):
        low, high = max(a - VOTERS + 1, 0), min(a + CHUNK + VOTERS - 1, len(data))
        levels = entropy_levels(data[low : high + WINDOW - 1])
        votes = np.full(high - low + 2 * (VOTERS - 1), last)  # neighbourhoods at the ends are smaller
        at = np.flatnonzero(inside[low : low + len(levels)])
        votes[at + VOTERS - 1] = (rank[levels[at]] << 32) | at
        chosen = slide(np.minimum, votes, VOTERS)
        got = np.bincount((chosen[chosen < last] & 0xFFFFFFFF).astype(np.int64), minlength=high - low)
        here = np.flatnonzero(got >= VOTES) + low
        held.append(here[(here >= a) & (here < a + CHUNK)])
    at = np.concatenate(held) if held else np.zeros(0, np.int64)
    text = np.searchsorted(offsets, at, "right") - 1
    size = np.full(len(at), WINDOW)
    # a text shorter than a window is one feature as it is
    lengths = np.diff(offsets)
    short = np.flatnonzero((lengths > 0) & (lengths < WINDOW))
    at, text, size = np.concatenate([at, offsets[short]]), np.concatenate([text, short]), np.concatenate([size, lengths[short]])
    padded = np.concatenate([data, np.zeros(WINDOW, np.uint8)])
    hashes = np.empty(len(at), np.uint64)
    for a in range(0, len(at), CHUNK):
        part = slice(a, a + CHUNK)
        rows = padded[at[part, None] + np.arange(WINDOW)]
        rows[np.arange(WINDOW) >= size[part, None]] = 0
        h = mix(size[part].astype(np.uint64) + np.uint64(1))
        for word in rows.view("<u8").T:
            h = mix(h ^ word)
        hashes[part] = h
    order = np.lexsort((at, hashes, text))
    first = np.ones(len(order), dtype=bool)
    first[1:] = (text[order][1:] != text[order][:-1]) | (hashes[order][1:] != hashes[order][:-1])
    kept = np.sort(order[first])
    kept = kept[np.lexsort((at[kept], text[kept]))]
    return text[kept], hashes[kept]


class Chains:
    """Chained Bloom filters of some texts: those of text i are bits[starts[i]:starts[i + 1]] with so many features."""

    def __init__(self, texts: list[bytes], rank: np.ndarray):
        offsets = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
        text, hashes = _features(np.frombuffer(b"".join(texts), np.uint8), offsets, rank)
        count = np.bincount(text, minlength=len(texts))
        nth = np.arange(len(text)) - (np.cumsum(count) - count)[text]
        filters = -(-count // FILTER_FEATURES)
        self.starts = np.concatenate([[0], np.cumsum(filters)])
        of = self.starts[text] + nth // FILTER_FEATURES
        bits = np.zeros((int(self.starts[-1]), FILTER_BITS), dtype=bool)
        for k in range(HASHES):
            bits[of, (hashes >> np.uint64(k * HASH_BITS)).astype(np.int64) & (FILTER_BITS - 1)] = True
        self.bits, self.features = np.packbits(bits, axis=1), np.bincount(of, minlength=len(bits))

    def chain(self, i: int) -> tuple[np.ndarray, np.ndarray]:
        here = slice(self.starts[i], self.starts[i + 1])
        return self.features[here], self.bits[here]

    def text(self, i: int) -> str:
        """The fingerprint: ``features:filter`` of each filter, comma-joined, the filter in base64; empty of an empty text."""
        return ",".join(f"{n}:{base64.b64encode(bits.tobytes()).decode()}" for n, bits in zip(*self.chain(i)))


def parse(fingerprint: str) -> tuple[np.ndarray, np.ndarray]:
    filters = [f.split(":") for f in fingerprint.split(",")] if fingerprint else []
    bits = np.frombuffer(b"".join(base64.b64decode(b) for _, b in filters), np.uint8).reshape(len(filters), FILTER_BITS // 8)
    return np.array([int(n) for n, _ in filters], dtype=np.int64), bits


def likeness(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """0 (no more than chance) to 1 (the smaller one lies in the other) of two chains; two empty ones are alike."""
    (na, bits_a), (nb, bits_b) = a, b
    if not len(na) or not len(nb):
        return float(len(na) == len(nb))
    best_a, best_b = np.zeros(len(na)), np.zeros(len(nb))
    y = np.unpackbits(bits_b, axis=1).astype(np.float32)
    set_b = y.sum(axis=1)
    for low in range(0, len(na), BLOCK):
        x = np.unpackbits(bits_a[low : low + BLOCK], axis=1).astype(np.float32)
        set_a = x.sum(axis=1)[:, None]
        chance = set_a * set_b / FILTER_BITS
        # min(a, b) < FILTER_BITS bits, so all that can be shared is more than chance
        score = (x @ y.T - chance) / np.maximum(np.minimum(set_a, set_b) - chance, 1e-6)
        score = np.where(score > NOISE, np.minimum(score, 1.0), 0.0)
        best_a[low : low + BLOCK] = score.max(axis=1)
        best_b = np.maximum(best_b, score.max(axis=0))
    one, other = float((best_a * na).sum() / na.sum()), float((best_b * nb).sum() / nb.sum())
    return one if na.sum() < nb.sum() else other if nb.sum() < na.sum() else (one + other) / 2


def fingerprints(docs: DataFrame, rank: np.ndarray, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, fingerprint) of every row, by the places that ``rarity`` gave; a null text is empty."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            chains = Chains([(t or "").encode() for t in batch.column("text").to_pylist()], rank)
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array([chains.text(i) for i in range(len(batch))], pa.string())], ["id", "fingerprint"])

    out = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, f"id {kind}, fingerprint string")
    return out.withColumnRenamed("id", id_col)


def edit(text: str, following: str) -> str:
    """``text`` with its last half (rounded down) replaced by as many first characters of ``following``."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def _deal(bounds: list[tuple]):
    """The bucket of each row by its key; copies within a batch as one row with their number.  The first document of a bucket also
    goes, as a guest, to the bucket before it (that of the first bucket to the last)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held: dict[tuple, list] = {}
            for row, (id_, digest, text) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("id", "digest", "text")))):
                held.setdefault((id_, digest, text), [row, 0])[1] += 1
            rows, buckets, guests, copies = [], [], [], []
            for (id_, digest, _), (row, n) in held.items():
                key = (id_ is not None, id_, digest)
                bucket = _find(bounds, key)
                rows.append(row), buckets.append(bucket), guests.append(False), copies.append(n)
                if key == bounds[bucket]:
                    rows.append(row), buckets.append((bucket - 1) % len(bounds)), guests.append(True), copies.append(0)
            out = batch.take(pa.array(rows, pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [*out.columns, pa.array(buckets, pa.int32()), pa.array(guests, pa.bool_()), pa.array(copies, pa.int64())], [*out.schema.names, "bucket", "guest", "copies"]
            )

    return run


def _find(bounds: list[tuple], key: tuple) -> int:
    """The last bound up to ``key``; nulls come first and are compared with nothing but nulls."""
    return bisect.bisect_right(bounds, (key[0], key[1] if key[0] else 0, key[2]), key=lambda b: (b[0], b[1] if b[0] else 0, b[2])) - 1


def compare_neighbours(docs: DataFrame, rank: np.ndarray, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: (id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next).

    Rows ascend by id (null first), rows of equal id by a hash of their text; the next document is the following row, of the
    last row the first one; repeated rows follow each other.  A null text is empty.  An empty table gives an empty result; other
    columns are ignored.  Texts are shuffled once, to buckets between known first keys; the last document of a
    bucket finds its next one in the guest of that bucket.
    """
    spark = docs.sparkSession
    kind = docs.schema[id_col].dataType.simpleString()
    base = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text")).select("id", F.xxhash64("text").alias("digest"), "text")
    order = [F.asc_nulls_first("id"), F.col("digest")]
    keys = base.select(F.col("id").isNotNull().alias("named"), "id", "digest")
    parts = keys.repartitionByRange(shuffle_partitions(spark), *order).withColumn("part", F.spark_partition_id())
    bounds = [tuple(r["key"]) for r in parts.groupBy("part").agg(F.min(F.struct("named", "id", "digest")).alias("key")).orderBy("part").collect()]  # a row a partition
    schema = f"id {kind}, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"

    def measured(rows: list[tuple], following: tuple) -> pa.RecordBatch:
        """Rows (id, text, copies) in order and the one after them."""
        texts = [t for _, t, _ in rows]
        nexts = [*texts[1:], following[1]]
        edited = [edit(t, n) for t, n in zip(texts, nexts)]
        twins = [(i, edit(t, t)) for i, (_, t, n) in enumerate(rows) if n > 1]  # a copy follows: the text itself is next
        encoded = [t.encode("utf-8", "surrogatepass") for t in [*texts, following[1], *edited, *(t for _, t in twins)]]
        chains, n = Chains(encoded, rank), len(rows)
        out = {c: [] for c in ("id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next", "times")}

        def put(i: int, e: int, beside: int, times: int) -> None:
            own = chains.chain(i)
            values = (rows[i][0], len(texts[i]), hashlib.sha256(encoded[e]).hexdigest(), chains.text(i), chains.text(e), likeness(own, chains.chain(e)), likeness(own, chains.chain(beside)))
            while times > 0:
                for column, value in zip(out.values(), (*values, min(times, COPIES))):
                    column.append(value)
                times -= COPIES

        for i in range(n):
            put(i, n + 1 + i, i + 1, 1)
        for k, (i, _) in enumerate(twins):
            put(i, 2 * n + 1 + k, i, rows[i][2] - 1)
        types = {"id": None, "n_chars": pa.int64(), "times": pa.int64(), "near_edited": pa.float64(), "near_next": pa.float64()}
        return pa.RecordBatch.from_pydict({c: pa.array(v, types.get(c, pa.string())) if c != "id" else pa.array(v, id_type) for c, v in out.items()})

    id_type = _arrow_type(kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []  # at least the last row, until the one after it is known
        guest = None
        for batch in slices(batches, "text"):
            for id_, text, copies, is_guest in zip(*(batch.column(c).to_pylist() for c in ("id", "text", "copies", "guest"))):
                if is_guest:
                    guest = guest or (id_, text, 0)
                elif held and held[-1][:2] == (id_, text):
                    held[-1] = (id_, text, held[-1][2] + copies)
                else:
                    held.append((id_, text, copies))
            if len(held) > 1:
                yield measured(held[:-1], held[-1])
                held = held[-1:]
        if held:
            if guest is None:
                raise RuntimeError("the first document of the next bucket is missing: the table changed while it was read")
            yield measured(held, guest)

    if not bounds:
        return spark.createDataFrame([], schema).withColumnRenamed("id", id_col)
    dealt = base.mapInArrow(_deal(bounds), f"id {kind}, digest long, text string, bucket int, guest boolean, copies long")
    result = (
        dealt.repartitionById(len(bounds), F.col("bucket"))
        .sortWithinPartitions("guest", *order)
        .mapInArrow(run, schema + ", times long")
        .withColumn("copy", F.explode(F.expr("sequence(1, times)")))
        .drop("times", "copy")
    )
    return result.withColumnRenamed("id", id_col)


def _arrow_type(kind: str) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type
    from pyspark.sql.types import _parse_datatype_string

    return to_arrow_type(_parse_datatype_string(kind))
