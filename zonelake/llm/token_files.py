"""Token ids of documents in binary files with Elias-Fano boundaries.

A file row (one segment) holds the ids of consecutive documents as one little-endian array, and where each document ends
as an Elias-Fano sequence: of every end the low bits are packed, the high bits are a unary bit vector in which the
k-th one stands at (high part + k).  ``select`` finds the k-th one through a sample of every SAMPLE-th one's place, so a
boundary is read without decoding the others, and the sequence takes about 2 + log2(ids / documents) bits a document
instead of a 64-bit table.  Segments are rows of Parquet files with binary columns, so they are
written and committed by Spark to any store it reaches.  Files follow ascending document ids.

segment: part, seq     place of the segment: range partition, number in it
         start         ids of all earlier segments of the partition
         doc_ids       document ids, little-endian 64-bit (and ``nulls``, a bit for each)
         ids, width    token ids, ``width`` bytes each
         n_ids, n_docs, low_bits, low, high, sample
"""

from __future__ import annotations

import json
import os
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import shuffle_partitions
from .words import slices, split_words, worker_cache

#: ones between two sampled places of the high bits
SAMPLE = 64
#: id that ends a document
END_ID = 1
#: words, and parts of words, whose ids a worker keeps
CACHED, CACHED_PARTS = 1_000_000, 700_000
#: bytes of text of a segment
SEGMENT_BYTES = 6 << 20

# fixed value: the rules of a lower-casing BPE tokenizer with word ends, as its file states them
RULES = {
    "normalizer": {
        "type": "Sequence",
        "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}],
    },
    "pre_tokenizer": {
        "type": "Sequence",
        "pretokenizers": [
            {
                "type": "Split",
                "pattern": {"Regex": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"},
                "behavior": "Removed",
                "invert": True,
            },
            {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
        ],
    },
    "model": {
        "type": "BPE",
        "dropout": None,
        "unk_token": None,
        "continuing_subword_prefix": None,
        "end_of_word_suffix": "</w>",
        "fuse_unk": False,
        "byte_fallback": False,
        "ignore_merges": False,
    },
}
#: ASCII and Latin-1 letters, then ASCII punctuation but the apostrophe
_SIMPLE = re.compile(r"([A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+)([!-&(-/:-@\[-`{-~]*)\Z")

_SEGMENT = (
    "part int, seq int, start long, n_docs int, n_ids long, doc_ids binary, nulls binary, width int, ids binary,"
    " low_bits int, low binary, high binary, sample binary"
)


def elias_fano(ends: np.ndarray) -> tuple[int, bytes, bytes, bytes]:
    """(low bits, packed low parts, high bits, sampled places of ones) of an ascending sequence."""
    n, last = len(ends), int(ends[-1]) if len(ends) else 0
    bits = max(0, (last // n).bit_length() - 1) if n else 0
    low = (ends[:, None] >> np.arange(bits)) & 1
    ones = (ends >> bits) + np.arange(n)
    high = np.zeros(int(ones[-1]) + 1 if n else 0, np.uint8)
    high[ones] = 1
    return bits, np.packbits(low.astype(np.uint8).ravel(), bitorder="little").tobytes(), np.packbits(high, bitorder="little").tobytes(), ones[::SAMPLE].astype("<u4").tobytes()


class EliasFano:
    """Reads one boundary (``select``) or all of them (``all``)."""

    def __init__(self, n: int, bits: int, low: bytes, high: bytes, sample: bytes):
        self.n, self.bits = n, bits
        self.low, self.high, self.sample = np.frombuffer(low, np.uint8), np.frombuffer(high, np.uint8), np.frombuffer(sample, "<u4")

    def _low(self, k: np.ndarray) -> np.ndarray:
        at = k[:, None] * self.bits + np.arange(self.bits)
        return (((self.low[at >> 3] >> (at & 7)) & 1).astype(np.int64) << np.arange(self.bits)).sum(axis=1)

    def select(self, k: int) -> int:
        """The k-th value, k from 0."""
        place, left = int(self.sample[k // SAMPLE]), k % SAMPLE
        byte, seen = place >> 3, -(int(self.high[place >> 3]) & ((1 << (place & 7)) - 1)).bit_count()
        while seen + (ones := int(self.high[byte]).bit_count()) <= left:
            seen, byte = seen + ones, byte + 1
        bits = np.flatnonzero((int(self.high[byte]) >> np.arange(8)) & 1)
        one = 8 * byte + int(bits[left - seen])
        return ((one - k) << self.bits) | int(self._low(np.array([k]))[0])

    def all(self) -> np.ndarray:
        ones = np.flatnonzero(np.unpackbits(self.high, bitorder="little"))[: self.n]
        return ((ones - np.arange(self.n)) << self.bits) | self._low(np.arange(self.n))


class WordEncoder:
    """Ids of texts by the tokenizers library.

    A tokenizer whose rules are RULES never joins anything over white space, and cuts a word of Latin letters and
    following punctuation between the two.  Then each distinct word is encoded once and the ids are put together: words of that form part by part with
    the library's BPE model, others with its whole chain.  Any other tokenizer gets whole texts.
    """

    def __init__(self, text: str):
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel

        self.tokenizer = Tokenizer.from_str(text)
        self.by_word = by_word(text)
        self.cache: dict[str, bytes] = {}  # of parts of words
        self.known: dict[bytes, bytes] = {}  # of words
        level = ByteLevel(add_prefix_space=False, use_regex=False)
        self.table = {ord(c): level.pre_tokenize_str(c)[0][0] for c in map(chr, range(0xC0, 0x100)) if c.isalpha()}

    def _part(self, part: str) -> bytes:
        ids = self.cache.get(part)
        if ids is None:
            tokens = self.tokenizer.model.tokenize(part.lower().translate(self.table))
            ids = self.cache[part] = np.array([t.id for t in tokens], np.uint32).tobytes()
        return ids

    def words(self, words: list[bytes]) -> list[bytes]:
        """The ids of each word, as bytes."""
        known = self.known
        out = list(map(known.get, words))
        new = [k for k, ids in enumerate(out) if ids is None]
        if len(known) + len(new) > CACHED:
            known.clear()  # but for these words
            known.update((w, ids) for w, ids in zip(words, out) if ids is not None)
        if len(self.cache) > CACHED_PARTS:
            self.cache.clear()
        other = []
        for k in new:
            m = _SIMPLE.match(text := words[k].decode("utf-8", "replace"))
            if m:
                letters, marks = m.groups()
                known[words[k]] = out[k] = self._part(letters) + self._part(marks) if marks else self._part(letters)
            else:
                other.append((k, text))
        for (k, _), encoding in zip(other, self.tokenizer.encode_batch_fast([t for _, t in other], add_special_tokens=False)):
            known[words[k]] = out[k] = np.array(encoding.ids, np.uint32).tobytes()
        return out

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids, ids of each row) of whole texts."""
        if not self.by_word:
            found = [e.ids for e in self.tokenizer.encode_batch_fast([t or "" for t in texts.to_pylist()], add_special_tokens=False)]
            return np.array([i for ids in found for i in ids], np.uint32), np.array([len(ids) for ids in found], np.int64)
        words = split_words(texts)
        pieces = self.words(words.words)
        size = np.array([len(p) >> 2 for p in pieces], np.int64)
        flat = np.frombuffer(b"".join(pieces), np.uint32)
        n = size[words.codes]
        begin = (np.cumsum(size) - size)[words.codes]
        ids = flat[np.repeat(begin - (np.cumsum(n) - n), n) + np.arange(n.sum())] if len(n) else flat[:0]
        ends = np.concatenate([[0], np.cumsum(n)])
        return ids, np.diff(ends[words.starts])


def by_word(tokenizer_json: str) -> bool:
    """Whether the rules before the BPE model, and its settings, are RULES."""
    held = json.loads(tokenizer_json)
    model = {k: v for k, v in held["model"].items() if k not in ("vocab", "merges")}
    spaced = any(set(t["content"]) & set(" \t\n\x0b\f\r") or t["lstrip"] or t["rstrip"] or t["normalized"] or t["content"][0].isalpha() for t in held["added_tokens"])
    return not spaced and {"normalizer": held["normalizer"], "pre_tokenizer": held["pre_tokenizer"], "model": model} == RULES


def _encoder(text: str) -> WordEncoder:
    held = worker_cache("tokenizer")
    if held.get("text") != text:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        held.clear()
        held.update(text=text, encoder=WordEncoder(text))
    return held["encoder"]


def _segments(model, width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(model.value)
        part, start = TaskContext.get().partitionId(), 0
        for seq, batch in enumerate(slices(batches, "text", SEGMENT_BYTES)):
            ids, counts = encoder.encode(batch.column("text"))
            ends = np.cumsum(counts + 1)
            out = np.full(int(ends[-1]), END_ID, f"<u{width}")
            where = np.ones(len(out), bool)
            where[ends - 1] = False
            out[where] = ids
            doc = batch.column("id")
            nulls = np.packbits(doc.is_null().to_numpy(zero_copy_only=False), bitorder="little").tobytes()
            bits, low, high, sample = elias_fano(ends)
            row = (part, seq, start, len(batch), len(out), doc.fill_null(0).to_numpy().astype("<i8").tobytes(), nulls, width, out.tobytes(), bits, low, high, sample)
            start += len(out)
            yield pa.RecordBatch.from_arrays([pa.array([x]) for x in row], [c.split()[0] for c in _SEGMENT.split(", ")]).cast(_ARROW)

    return run


_ARROW = pa.schema([(c.split()[0], {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary()}[c.split()[1]]) for c in _SEGMENT.split(", ")])


def write_tokens(docs: DataFrame, path: str, tokenizer_json: str, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Encode every whole text (null: empty), end each with END_ID and write the segments under ``path``.

    Rows are dealt by ranges of (id, hash of the text) and sorted in each, so files ascend by id; null ids come first, rows of equal id
    stand next to each other.  Ids are integers.  An empty table writes no segments.  Other columns are ignored.
    """
    from tokenizers import Tokenizer

    spark = docs.sparkSession
    model = spark.sparkContext.broadcast(tokenizer_json)  # a vocabulary: a few MB
    width = 2 if Tokenizer.from_str(tokenizer_json).get_vocab_size(True) <= 1 << 16 else 4
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    (
        docs.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(text).alias("dig"), text.alias("text"))
        .repartitionByRange(shuffle_partitions(spark), "id", "dig")
        .sortWithinPartitions("id", "dig")
        .select("id", "text")
        .mapInArrow(_segments(model, width), _SEGMENT)
        .write.option("compression", "zstd")
        .parquet(path)
    )


def _documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for s in batch.to_pylist():
            ends = EliasFano(s["n_docs"], s["low_bits"], s["low"], s["high"], s["sample"]).all()
            begins = np.concatenate([[0], ends[:-1]])
            ids = np.frombuffer(s["ids"], f"<u{s['width']}").astype("<u4")
            null = np.unpackbits(np.frombuffer(s["nulls"], np.uint8), bitorder="little")[: s["n_docs"]].astype(bool)
            crc = [zlib.crc32(ids[a:b].data) for a, b in zip(begins.tolist(), ends.tolist())]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.frombuffer(s["doc_ids"], "<i8"), mask=null),
                    pa.array(np.full(len(ends), s["part"], np.int32)),
                    pa.array(begins + s["start"]),
                    pa.array(ends - begins),
                    pa.array(crc, pa.int64()),
                ],
                ["id", "part", "at", "n_tokens", "ids_crc32"],
            )


def read_index(spark: SparkSession, path: str, id_col: str = "doc_id") -> DataFrame:
    """From the files, per document: (id, start, n_tokens, ids_crc32); ``start`` counts the ids of all documents before it."""
    files = spark.read.schema(_SEGMENT).parquet(path)
    totals = sorted((r["part"], r["n"]) for r in files.groupBy("part").agg(F.sum("n_ids").alias("n")).collect())  # a row per partition
    before, done = [], 0
    for part, n in totals:
        before.append((part, done))
        done += n
    offsets = F.broadcast(spark.createDataFrame(before, "part int, before long"))
    return (
        files.mapInArrow(_documents, "id long, part int, at long, n_tokens long, ids_crc32 long")
        .join(offsets, "part")
        .select(F.col("id").alias(id_col), (F.col("before") + F.col("at")).alias("start"), "n_tokens", "ids_crc32")
    )


def read_tokens(spark: SparkSession, path: str, id_col: str = "doc_id") -> DataFrame:
    """From the files, per document: (id, ids with the end id)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for s in batch.to_pylist():
                ends = EliasFano(s["n_docs"], s["low_bits"], s["low"], s["high"], s["sample"]).all()
                null = np.unpackbits(np.frombuffer(s["nulls"], np.uint8), bitorder="little")[: s["n_docs"]].astype(bool)
                flat = pa.array(np.frombuffer(s["ids"], f"<u{s['width']}").astype(np.int32))
                lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]).astype(np.int32)), flat)
                yield pa.RecordBatch.from_arrays([pa.array(np.frombuffer(s["doc_ids"], "<i8"), mask=null), lists], ["id", "ids"])

    return spark.read.schema(_SEGMENT).parquet(path).mapInArrow(run, "id long, ids array<int>").withColumnRenamed("id", id_col)
