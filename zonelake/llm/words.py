"""Words of a batch of texts as integer codes, and hashes of runs of words, in NumPy.

A word is a run of bytes other than the six ASCII white-space characters (U+0020, U+0009 to U+000D).
"""

from __future__ import annotations

import sys
import types
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash

#: bytes of text worked on at once in a Python worker
SLICE_BYTES = 4 << 20

_SPACES = np.zeros(256, dtype=bool)
_SPACES[[32, *range(9, 14)]] = True

_ODD = 0x9E3779B97F4A7C15
_ODD_INVERSE = pow(_ODD, -1, 1 << 64)


def slices(batches: Iterator[pa.RecordBatch], column: str, size: int | None = None) -> Iterator[pa.RecordBatch]:
    """The same rows in pieces of about ``size`` (SLICE_BYTES) bytes of ``column`` (one row at least)."""
    for batch in batches:
        if not batch.num_rows:
            continue
        ends = binary(batch.column(column))[1][1:]
        at = 0
        while at < batch.num_rows:
            done = int(ends[at - 1]) if at else 0
            n = max(1, int(np.searchsorted(ends, done + (size or SLICE_BYTES), "right")) - at)
            yield batch.slice(at, n)
            at += n


def binary(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets from 0) of a string or binary array; null is empty."""
    a = texts.cast(pa.large_binary()) if not pa.types.is_large_binary(texts.type) else texts
    if a.null_count:
        a = a.fill_null(b"")
    _, offsets, data = a.buffers()
    offs = np.frombuffer(offsets, np.int64)[a.offset : a.offset + len(a) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offs[0] : offs[-1]], offs - offs[0]


@dataclass
class Words:
    """``codes`` index ``words``; those of row i are codes[starts[i]:starts[i + 1]].  ``data`` are the bytes with every
    white-space byte turned into a space; word k is data[begin[k]:end[k]]."""

    codes: np.ndarray
    starts: np.ndarray
    words: list[bytes]
    data: np.ndarray
    begin: np.ndarray
    end: np.ndarray

    def rows(self) -> np.ndarray:
        """The row of each word."""
        return np.repeat(np.arange(len(self.starts) - 1), np.diff(self.starts))


def split_words(texts: pa.Array, coded: bool = True) -> Words:
    """The words of every row; without ``coded`` only where they stand."""
    raw, offs = binary(texts)
    data = raw.copy()
    space = _SPACES[data]
    data[space] = 32
    # a word begins where no space is, after a space or at the begin of a row
    first = ~space
    first[1:] &= space[:-1]
    row_begins = offs[:-1][offs[:-1] < len(data)]
    first[row_begins] = ~space[row_begins]
    begin = np.flatnonzero(first)
    last = ~space
    last[:-1] &= space[1:]
    row_ends = offs[1:][offs[1:] > 0] - 1
    last[row_ends] = ~space[row_ends]
    end = np.flatnonzero(last) + 1
    starts = np.searchsorted(begin, offs)
    if not coded:
        return Words(np.zeros(len(begin), np.int64), starts, [], data, begin, end)
    # without the spaces the words lie one after another
    ends = np.concatenate([[0], np.cumsum(end - begin)])
    codes, words = coded_runs(data[~space], ends)
    return Words(codes, starts, words, data, begin, end)


def coded_runs(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, list[bytes]]:
    """(codes, distinct runs) of the runs of bytes between neighbouring bounds."""
    small = len(data) < 1 << 31
    offsets = bounds.astype(np.int32 if small else np.int64)
    runs = pa.Array.from_buffers(pa.binary() if small else pa.large_binary(), len(bounds) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data))])
    coded = runs.dictionary_encode()
    whole, at = binary(coded.dictionary)
    whole, at = whole.tobytes(), at.tolist()
    return coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), [whole[a:b] for a, b in zip(at, at[1:])]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective mixing of 64-bit values."""
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def hash_words(words: list[bytes]) -> np.ndarray:
    return np.array([xxhash.xxh3_64_intdigest(w) for w in words], dtype=np.uint64)


class Names:
    """64-bit names of runs of words: equal runs have equal names wherever they stand."""

    def __init__(self, hashes: np.ndarray):
        n = len(hashes)
        powers = np.full(n, _ODD, dtype=np.uint64)
        inverse = np.full(n, _ODD_INVERSE, dtype=np.uint64)
        if n:
            powers[0] = inverse[0] = 1
        self.inverse = np.multiply.accumulate(inverse)
        self.sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(hashes * np.multiply.accumulate(powers), dtype=np.uint64)])

    def of(self, at: np.ndarray, length) -> np.ndarray:
        """Names of the runs of ``length`` words (a number or an array) that start at ``at``."""
        return mix((self.sums[at + length] - self.sums[at]) * self.inverse[at])


def slide(op, x: np.ndarray, width: int) -> np.ndarray:
    """``op`` (np.minimum or np.maximum) over every ``width`` neighbours of x."""
    done = 1
    while 2 * done <= width:
        x = op(x[:-done], x[done:])
        done *= 2
    return op(x[: len(x) - (width - done)], x[width - done :]) if width > done else x


def grouped(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """The runs of equal ``key`` (not null) of a sorted stream, each as one table."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = batch.column(key).to_numpy(zero_copy_only=False)
        cuts = [0, *(np.flatnonzero(keys[1:] != keys[:-1]) + 1).tolist(), batch.num_rows]
        if held and held[-1].column(key)[0].as_py() != keys[0]:
            yield pa.Table.from_batches(held)
            held = []
        for a, b in zip(cuts, cuts[1:]):
            held.append(batch.slice(a, b - a))
            if b < batch.num_rows:
                yield pa.Table.from_batches(held)
                held = []
    if held:
        yield pa.Table.from_batches(held)


def worker_cache(name: str) -> dict:
    """A dictionary that lives as long as the Python worker, over its tasks."""
    return sys.modules.setdefault("_zonelake_worker", types.ModuleType("_zonelake_worker")).__dict__.setdefault(name, {})
