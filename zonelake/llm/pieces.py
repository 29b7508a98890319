"""SentencePiece BPE encoding by suffix-array matching, and decoding.

Per slice of texts, in NumPy inside a Spark task:

1. Texts are cut into units, a run of spaces and the word after it; no piece reaches over the end of a unit.  Units that the worker has not met
   are concatenated and indexed by a suffix array over as many bytes as the longest piece has.
2. Every piece of the vocabulary is looked up by binary search; its range in the suffix array are its occurrences, the edges of
   a lattice over the text.
3. Edges are sorted by where they end and relaxed in that order.  BPE has no path cost to add up; its result is the one path on
   which any two neighbouring pieces, put together and encoded alone, come out as themselves.  (Merges go best first, so the first merge
   over a border of pieces would also happen in those two alone.)  So a position keeps the one edge that ends the BPE encoding of the
   unit up to there: the edge whose piece fits the piece kept at its start.
4. Characters that are no piece become bytes (byte fallback).

A long unit is cut between two characters that stand side by side in no piece: nothing merges over such a border.  A stretch that is
still long is indexed window by window and relaxed edge by edge, since a position looks back no further than the longest piece; so
are runs of spaces.  Time and memory thus grow in proportion to a unit, whatever it holds.

The vocabulary (pieces, scores) is a parameter of a few MB and is broadcast.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .words import binary, coded_runs, slices, worker_cache

#: units whose ids a worker keeps, and pairs of pieces
CACHED_UNITS, CACHED_PAIRS = 700_000, 500_000
#: bytes of units that are indexed at once (an edge takes about 60 bytes, a byte has about five)
INDEX_BYTES = 400_000
#: bytes of a unit that is cut where no piece can stand, and bytes of a stretch without such a place that are indexed at once
LONG, WINDOW = 2048, 100_000

_SPACE = "▁"


def load_vocabulary(model_file: str) -> dict:
    """Plain data of a BPE model with byte fallback: pieces with spaces for U+2581, scores, and the ids of bytes."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=model_file)
    pieces, scores, usable = [], [], []
    for i in range(sp.get_piece_size()):
        pieces.append(sp.id_to_piece(i).replace(_SPACE, " "))
        scores.append(sp.get_score(i))
        usable.append(not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i)))
    if any(u and " " in p[1:] and p.strip(" ") for p, u in zip(pieces, usable)):
        raise ValueError("a piece holds a space inside")
    return {
        "pieces": pieces,
        "scores": scores,
        "usable": usable,
        "bytes": [sp.piece_to_id(f"<0x{b:02X}>") for b in range(256)],
        "control": [i for i in range(len(pieces)) if sp.is_control(i)],
        "unknown": sp.unk_id(),
    }


class PairTable:
    """A hash table of pairs (not negative) and whether they fit, looked up by the array; emptied where it would outgrow CACHED_PAIRS."""

    def __init__(self):
        self._clear(1 << 16)

    def _clear(self, slots: int) -> None:
        self.keys, self.fits, self.used = np.full(slots, -1, np.int64), np.zeros(slots, bool), 0
        self.shift = np.uint64(64 - (slots.bit_length() - 1))

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def get(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(fits, known)."""
        slot = self._slot(keys)
        held = self.keys[slot]
        known, fits = held == keys, self.fits[slot]
        on = np.flatnonzero(~known & (held >= 0))
        while len(on):
            slot[on] = (slot[on] + 1) & (len(self.keys) - 1)
            held = self.keys[slot[on]]
            hit = held == keys[on]
            known[on[hit]], fits[on[hit]] = True, self.fits[slot[on[hit]]]
            on = on[~hit & (held >= 0)]
        return fits & known, known

    def put(self, keys: np.ndarray, fits: np.ndarray) -> None:
        """Distinct pairs that are not in the table."""
        if 2 * (self.used + len(keys)) > len(self.keys):
            old = self.keys >= 0
            if self.used + len(keys) <= CACHED_PAIRS:
                keys, fits = np.concatenate([self.keys[old], keys]), np.concatenate([self.fits[old], fits])
            self._clear(1 << (4 * len(keys)).bit_length())
        self.used += len(keys)
        slot = self._slot(keys)
        left = np.arange(len(keys))
        while len(left):
            free = self.keys[slot[left]] < 0
            self.keys[slot[left[free]]] = keys[left[free]]  # of several in one slot the last stays
            done = self.keys[slot[left]] == keys[left]
            self.fits[slot[left[done]]] = fits[left[done]]
            left = left[~done]
            slot[left] = (slot[left] + 1) & (len(self.keys) - 1)


class Encoder:
    """One vocabulary with what has been learnt of it: fitting pairs and the ids of units."""

    def __init__(self, vocabulary: dict):
        self.pieces, usable = vocabulary["pieces"], vocabulary["usable"]
        self.score = {p: s for p, s, u in zip(self.pieces, vocabulary["scores"], usable) if u}
        self.ids = {p: i for i, (p, u) in enumerate(zip(self.pieces, usable)) if u}
        self.byte_ids = np.array(vocabulary["bytes"], np.int64)
        self.unknown_edge = len(self.pieces)  # stands for a character that is no piece
        listed = [(p.encode(), i) for p, i in self.ids.items() if not p.startswith("  ")]
        self.listed_ids = np.array([i for _, i in listed], np.int64)
        self.lengths = np.array([len(b) for b, _ in listed], np.int64)
        self.depth = 2  # 8-byte keys of a suffix; what a longer piece has beyond them is compared where it may stand
        low = np.zeros((len(listed), 8 * self.depth), np.uint8)
        high = np.full_like(low, 255)
        for k, (b, _) in enumerate(listed):
            b = b[: 8 * self.depth]
            low[k, : len(b)] = high[k, : len(b)] = np.frombuffer(b, np.uint8)
        self.long = [(k, b[8 * self.depth :]) for k, (b, _) in enumerate(listed) if len(b) > 8 * self.depth]
        self.low, self.high = (x.reshape(-1).view(">u8").astype(np.uint64).reshape(-1, self.depth) for x in (low, high))
        self.alone = np.array([u and self.merge(p) == [p] for p, u in zip(self.pieces, usable)] + [True])
        pairs = {(ord(x) << 32) | ord(y) for p in self.ids for x, y in zip(p, p[1:])}
        self.beside = np.array(sorted(pairs) or [0], np.int64)
        self.spaces = sorted(len(p) for p in self.ids if p and not p.strip(" "))
        self.pairs = PairTable()
        self.units: dict[bytes, bytes] = {}

    def merge(self, text: str) -> list[str]:
        """BPE of a short text as it is defined: the best-scored neighbours first, the left ones of equals."""
        parts, score = list(text), self.score
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                s = score.get(parts[i] + parts[i + 1])
                if s is not None and (best is None or s > best):
                    best, at = s, i
            if at < 0:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def fitting(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Whether each pair of pieces, put together, is encoded as the two."""
        size = len(self.pieces) + 1
        keys = left.astype(np.int64) * size + right
        fits, found = self.pairs.get(keys)
        if not found.all():
            new = np.unique(keys[~found])
            self.pairs.put(new, np.array([self._fit(*divmod(k, size)) for k in new.tolist()], bool))
            fits[~found] = self.pairs.get(keys[~found])[0]
        return fits

    def _fit(self, a: int, b: int) -> bool:
        if self.unknown_edge in (a, b):  # nothing merges with it
            return bool(self.alone[a] and self.alone[b])
        left, right = self.pieces[a], self.pieces[b]
        return self.merge(left + right) == [left, right]

    def _edges(self, text: np.ndarray):
        """(start, end, piece) of every occurrence of every piece in the bytes of ``text``."""
        padded = np.concatenate([text, np.zeros(8 * self.depth, np.uint8)]).astype(np.uint64)
        key = np.zeros(len(text) + 8 * (self.depth - 1), np.uint64)
        for k in range(8):
            key = (key << np.uint64(8)) | padded[k : k + len(key)]
        keys = [key[8 * d : 8 * d + len(text)] for d in range(self.depth)]
        suffixes = np.lexsort(keys[::-1])
        ranked = [k[suffixes] for k in keys]

        def bound(wanted: np.ndarray, after: bool) -> np.ndarray:
            """Binary search of all pieces at once: how many suffixes are less (or not more)."""
            first, last = np.zeros(len(wanted), np.int64), np.full(len(wanted), len(suffixes), np.int64)
            while (open_ := first < last).any():
                middle = (first + last) >> 1
                look = np.minimum(middle, len(suffixes) - 1)
                less, same = np.zeros(len(wanted), bool), np.ones(len(wanted), bool)
                for d in range(self.depth):
                    less |= same & (ranked[d][look] < wanted[:, d])
                    same &= ranked[d][look] == wanted[:, d]
                go = open_ & (less | (same if after else False))
                first = np.where(go, middle + 1, first)
                last = np.where(open_ & ~go, middle, last)
            return first

        first, last = bound(self.low, False), bound(self.high, True)
        n = last - first
        at = suffixes[np.repeat(first - (np.cumsum(n) - n), n) + np.arange(n.sum())]
        real = np.ones(len(at), bool)
        stops = np.cumsum(n)
        whole = text.tobytes()
        for k, rest in self.long:
            for i in range(stops[k] - n[k], stops[k]):
                begin = int(at[i]) + 8 * self.depth
                real[i] = whole[begin : begin + len(rest)] == rest
        at, length, piece = at[real], np.repeat(self.lengths, n)[real], np.repeat(self.listed_ids, n)[real]
        return at.astype(np.int32), (at + length).astype(np.int32), piece.astype(np.int32)

    def _encode_cores(self, cores: list[bytes]) -> list[bytes]:
        """Ids (32-bit, as bytes) of units with one leading space at most."""
        size = np.array([len(c) for c in cores], np.int64)
        text = np.frombuffer(b"\xff".join(cores), np.uint8)  # no UTF-8 byte
        begin = np.cumsum(size + 1) - size - 1
        start, end, piece = self._edges(text)
        # a character that is no piece by itself: an edge over its bytes
        head = np.flatnonzero((text & 0xC0) != 0x80)
        tail = np.append(head[1:], len(text))
        single = np.zeros(len(text) + 1, bool)
        to_next = np.zeros(len(text) + 1, np.int32)
        to_next[head] = tail
        single[start[end == to_next[start]]] = True
        lone = ~single[head] & (text[head] != 255)
        start = np.concatenate([start, head[lone].astype(np.int32)])
        end = np.concatenate([end, tail[lone].astype(np.int32)])
        piece = np.concatenate([piece, np.full(int(lone.sum()), self.unknown_edge, np.int32)])
        unit_begin = np.repeat(begin.astype(np.int32), size + 1)[: len(text)]
        inside = end - unit_begin[start]
        order = np.argsort(inside.astype(np.uint16) if len(inside) and inside.max() < 1 << 16 else inside, kind="stable")
        start, end, piece, inside = start[order], end[order], piece[order], inside[order]
        kept, origin = np.full(len(text) + 1, -1, np.int32), np.zeros(len(text) + 1, np.int32)
        first = start == unit_begin[start]
        levels = np.append(np.flatnonzero(np.append(True, inside[1:] != inside[:-1])), len(inside)) if len(inside) else [0]
        for a, b in zip(levels[:-1], levels[1:]):
            s, e, p, begins = start[a:b], end[a:b], piece[a:b], first[a:b]
            left = kept[s]
            good = begins & self.alone[p]
            rest = np.flatnonzero(~begins & (left >= 0))
            good[rest] = self.fitting(left[rest], p[rest])
            kept[e[good]], origin[e[good]] = p[good], s[good]
        # walk back from the ends of all units at once
        unit, at = np.arange(len(cores)), begin + size
        steps = []
        live = at > begin
        unit, at = unit[live], at[live]
        while len(unit):
            steps.append((unit, kept[at], origin[at]))
            if (kept[at] < 0).any():
                raise ValueError("a unit without an encoding")
            at = origin[at]
            live = at > begin[unit]
            unit, at = unit[live], at[live]
        if not steps:
            return [b"" for _ in cores]
        unit = np.concatenate([s[0] for s in steps[::-1]])
        ids = np.concatenate([s[1] for s in steps[::-1]])
        places = np.concatenate([s[2] for s in steps[::-1]])
        order = np.argsort(unit, kind="stable")
        unit, ids, places = unit[order], ids[order], places[order]
        cuts = np.searchsorted(unit, np.arange(len(cores) + 1)).tolist()
        flat = ids.astype(np.int32).tobytes()
        out = [flat[4 * a : 4 * b] for a, b in zip(cuts, cuts[1:])]
        for k in np.unique(unit[ids == self.unknown_edge]).tolist():
            spelled: list[int] = []
            for i in range(cuts[k], cuts[k + 1]):
                stop = places[i + 1] if i + 1 < cuts[k + 1] else begin[k] + size[k]
                spelled += self.byte_ids[text[places[i] : stop]].tolist() if ids[i] == self.unknown_edge else [int(ids[i])]
            out[k] = np.array(spelled, np.int32).tobytes()
        return out

    def _stretches(self, core: bytes) -> list[bytes]:
        """``core`` cut between characters that are neighbours in no piece."""
        chars = np.frombuffer(core.decode().encode("utf-32-le"), np.uint32).astype(np.int64)
        pairs = (chars[:-1] << 32) | chars[1:]
        apart = self.beside[np.minimum(np.searchsorted(self.beside, pairs), len(self.beside) - 1)] != pairs
        sizes = np.cumsum(1 + (chars >= 0x80) + (chars >= 0x800) + (chars >= 0x10000))
        cuts = [0, *sizes[:-1][apart].tolist(), len(core)]
        return [core[a:b] for a, b in zip(cuts, cuts[1:])]

    def _encode_long(self, core: bytes) -> bytes:
        """Ids of a stretch of any length: its edges window by window, relaxed one after another."""
        size, reach = len(core), int(self.lengths.max())
        kept, origin = array("i", [-1]) * (size + 1), array("i", [0]) * (size + 1)
        alone, unknown, fits, width = self.alone.tolist(), self.unknown_edge, {}, len(self.pieces) + 1
        for low in range(0, size, WINDOW):
            begin, stop = max(low - reach, 0), min(low + WINDOW + reach, size)  # the pieces that end in the window are whole in it
            text = np.frombuffer(core[begin:stop], np.uint8)
            start, end, piece = self._edges(text)
            head = np.flatnonzero((text & 0xC0) != 0x80)
            tail = np.append(head[1:], len(text))
            single = np.isin(head, start[np.isin(end, tail) & (np.append(tail, -1)[np.minimum(np.searchsorted(head, start), len(head))] == end)])
            start = np.concatenate([start, head[~single]]) + begin
            end = np.concatenate([end, tail[~single]]) + begin
            piece = np.concatenate([piece, np.full(int((~single).sum()), unknown)])
            here = (end > low) & (end <= low + WINDOW)
            start, end, piece = start[here], end[here], piece[here]
            order = np.argsort(end, kind="stable")
            if len(fits) > CACHED_PAIRS:
                fits.clear()
            for s, e, p in zip(start[order].tolist(), end[order].tolist(), piece[order].tolist()):
                if s == 0:
                    good = alone[p]
                elif kept[s] < 0:
                    continue
                else:
                    pair = kept[s] * width + p
                    good = fits.get(pair)
                    if good is None:
                        good = fits[pair] = self._fit(kept[s], p)
                if good:
                    kept[e], origin[e] = p, s
        ids, at = array("i"), size
        while at > 0:
            if kept[at] < 0:
                raise ValueError("a unit without an encoding")
            if kept[at] == unknown:
                ids.extend(self.byte_ids[np.frombuffer(core[origin[at] : at][::-1], np.uint8)].tolist())
            else:
                ids.append(kept[at])
            at = origin[at]
        ids.reverse()
        return ids.tobytes()

    def _encode_spaces(self, n: int) -> bytes:
        """Ids of a run of spaces: the same relaxation, where a piece is its length."""
        if n <= 2 * self.spaces[-1]:
            return np.array([self.ids[p] for p in self.merge(" " * n)], np.int32).tobytes()
        fit = {(a, b): self.merge(" " * (a + b)) == [" " * a, " " * b] for a in self.spaces for b in self.spaces}
        before = {b: {a for a in self.spaces if fit[a, b]} for b in self.spaces}
        first = {b for b in self.spaces if self.merge(" " * b) == [" " * b]}
        kept = array("i", [0]) * (n + 1)
        for e in range(1, n + 1):
            for b in self.spaces:
                if b > e:
                    break
                if (b in first) if b == e else kept[e - b] in before[b]:
                    kept[e] = b
                    break
        ids, at = array("i"), n
        while at > 0:
            ids.append(self.ids[" " * kept[at]])
            at -= kept[at]
        ids.reverse()
        return ids.tobytes()

    def learn(self, units: list[bytes]) -> dict[bytes, bytes]:
        """Encode units (the shorter ones are kept): spaces beyond the first are a run of their own, joined by the first if that
        stays alone."""
        extra = {u: len(u) - len(u.lstrip(b" ")) - 1 for u in units if u[:2] == b"  "}
        wanted = list({u[extra[u] :] if u in extra else u for u in units} - {b""}) if extra else units
        cut = {c: self._stretches(c) for c in wanted if len(c) > LONG}
        cores = list({s for c in wanted for s in cut.get(c, (c,))}) if cut else wanted
        ids, part, size = {}, [], 0
        for core in cores:
            if len(core) > LONG:
                ids[core] = self._encode_long(core)
                continue
            part.append(core)
            size += len(core)
            if size >= INDEX_BYTES:
                ids.update(zip(part, self._encode_cores(part)))
                part, size = [], 0
        if part:
            ids.update(zip(part, self._encode_cores(part)))
        ids.update({c: b"".join(ids[s] for s in stretches) for c, stretches in cut.items()})
        space = self.ids.get(" ")
        for u, n in extra.items():
            found = np.frombuffer(ids[u[n:]], np.int32)
            joins = bool(len(found)) and found[0] == space
            ids[u] = self._encode_spaces(n + joins) + found[int(joins) :].tobytes()
        self.units.update((u, ids[u]) for u in units if len(u) <= LONG)
        return ids


def _cut_units(texts: pa.Array):
    """(dictionary of units, codes, units of each row): spaces and the bytes up to the next space; the other five ASCII white
    spaces stand alone.  Texts come with their leading space."""
    data, offs = binary(texts)
    control = (data >= 9) & (data <= 13)
    space = data == 32
    bound = np.zeros(len(data) + 1, dtype=bool)
    bound[offs] = True
    if len(data):
        bound[1:-1] |= space[1:] & ~space[:-1]
        bound[:-1] |= control
        bound[1:] |= control
    bounds = np.flatnonzero(bound)
    if len(bounds) < 2:
        return [], np.zeros(0, np.int64), np.zeros(len(offs), np.int64)
    codes, units = coded_runs(data, bounds)
    return units, codes, np.searchsorted(bounds, offs)


def _encoder(vocabulary: dict) -> Encoder:
    held = worker_cache("pieces")
    if held.get("pieces") != vocabulary["pieces"] or held.get("scores") != vocabulary["scores"]:
        held.clear()
        held.update(pieces=vocabulary["pieces"], scores=vocabulary["scores"], encoder=Encoder(vocabulary))
    return held["encoder"]


def _encode(texts: pa.Array, encoder: Encoder) -> tuple[np.ndarray, np.ndarray]:
    """(ids, where each row's begin) of texts with their leading space."""
    units, codes, starts = _cut_units(texts)
    cache = encoder.units
    pieces = list(map(cache.get, units))
    new = [u for u, ids in zip(units, pieces) if ids is None]
    if new:
        if len(cache) + len(new) > CACHED_UNITS:  # keep what this slice has
            cache.clear()
            cache.update((u, ids) for u, ids in zip(units, pieces) if ids is not None)
        learnt = encoder.learn(new)
        pieces = [learnt[u] if ids is None else ids for u, ids in zip(units, pieces)]
    size = np.array([len(p) >> 2 for p in pieces], np.int64)
    flat = np.frombuffer(b"".join(pieces), np.int32)
    n = size[codes] if len(codes) else size[:0]
    begin = (np.cumsum(size) - size)[codes] if len(codes) else size[:0]
    ids = flat[np.repeat(begin - (np.cumsum(n) - n), n) + np.arange(n.sum())] if len(n) else flat[:0]
    return ids, np.concatenate([[0], np.cumsum(n)])[starts]


def _byte_table(vocabulary: dict) -> tuple[np.ndarray, np.ndarray]:
    """(bytes of all pieces, where each begins)."""
    table = [p.encode() for p in vocabulary["pieces"]]
    for b, i in enumerate(vocabulary["bytes"]):
        table[i] = bytes([b])
    for i in vocabulary["control"]:
        table[i] = b""
    table[vocabulary["unknown"]] = " \u2047 ".encode()
    return np.frombuffer(b"".join(table), np.uint8), np.concatenate([[0], np.cumsum([len(t) for t in table])])


def _decode(ids: np.ndarray, starts: np.ndarray, table: tuple[np.ndarray, np.ndarray]) -> pa.Array:
    """Texts of the rows of ids."""
    flat, place = table
    n = place[ids + 1] - place[ids]
    data = flat[np.repeat(place[ids] - (np.cumsum(n) - n), n) + np.arange(n.sum())] if len(ids) else flat[:0]
    bounds = np.concatenate([[0], np.cumsum(n)])[starts]
    # the space that encoding put first
    begins = bounds[:-1] + ((bounds[1:] > bounds[:-1]) & (np.append(data, 0)[bounds[:-1]] == 32))
    whole = data.tobytes()
    return pa.array([whole[a:b].decode("utf-8", "replace") for a, b in zip(begins.tolist(), bounds[1:].tolist())], pa.string())


def encode(docs: DataFrame, vocabulary: dict, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = (), decoded: bool = False) -> DataFrame:
    """(id, ids, columns named in ``keep``): the ids of every whole text, as the model's own BPE gives them.
    With ``decoded`` also the text that the ids decode to, in the same pass.

    A space is put before a text that is not empty; null and empty texts have no ids.  Repeated rows, null ids and other
    columns are as they are; an empty table gives an empty result.
    """
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    spaced = F.when(text == "", F.lit("")).otherwise(F.concat(F.lit(" "), F.replace(text, F.lit(_SPACE), F.lit(" "))))
    rows = docs.select(F.struct(F.col(id_col).alias("id"), *[F.col(c).alias(f"k{i}") for i, c in enumerate(keep)]).alias("row"), spaced.alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, table = _encoder(shared.value), _byte_table(shared.value)
        for batch in slices(batches, "text"):
            ids, starts = _encode(batch.column("text"), encoder)
            columns = [batch.column("row"), pa.ListArray.from_arrays(pa.array(starts.astype(np.int32)), pa.array(ids))]
            yield pa.RecordBatch.from_arrays([*columns, _decode(ids, starts, table)] if decoded else columns, names)

    names = ["row", "ids", *["decoded"] * decoded]
    out = rows.mapInArrow(run, f"row {rows.schema['row'].dataType.simpleString()}, ids array<int>" + ", decoded string" * decoded)
    return out.select(F.col("row.id").alias(id_col), *names[1:], *[F.col(f"row.k{i}").alias(c) for i, c in enumerate(keep)])


def decode(encoded: DataFrame, vocabulary: dict, ids_col: str = "ids", as_col: str = "decoded") -> DataFrame:
    """``encoded`` with the text of its ids in a further column.  Byte ids give their bytes (U+FFFD for those that are no UTF-8), control ids nothing,
    unknown ones U+2047 in spaces; a first space goes.  Null ids give null; ids outside the vocabulary are an error."""
    shared = encoded.sparkSession.sparkContext.broadcast(vocabulary)

    @F.pandas_udf("string")
    def text_of(lists):
        import pandas as pd

        table = _byte_table(shared.value)
        have = [x if x is not None else np.zeros(0, np.int64) for x in lists]
        starts = np.concatenate([[0], np.cumsum([len(x) for x in have])]).astype(np.int64)
        texts = _decode(np.concatenate([*have, np.zeros(0, np.int64)]).astype(np.int64), starts, table).to_pylist()
        return pd.Series([None if x is None else t for x, t in zip(lists, texts)], dtype=object)

    return encoded.withColumn(as_col, text_of(F.col(ids_col)))
