from __future__ import annotations

import hashlib
import math
from collections import Counter

import numpy as np
import pytest

from zonelake.llm import fingerprints as fp
from zonelake.llm.queries import QUERIES
from zonelake.llm.words import mix

from .conftest import tuples

COLUMNS = ("doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next")


def level(window: bytes) -> int:
    spread = sum(round(c * math.log2(c) * fp._UNIT) for c in Counter(window).values())
    full = round(fp.WINDOW * math.log2(fp.WINDOW) * fp._UNIT)
    return (full - spread) * fp.LEVELS // full


def brute_rank(texts: list[str]) -> list[int]:
    seen = Counter()
    for t in texts:
        data = t.encode()
        seen.update(level(data[i : i + fp.WINDOW]) for i in range(len(data) - fp.WINDOW + 1))
    order = sorted(range(fp.LEVELS + 1), key=lambda e: (e < fp.WEAK, seen[e], e))
    return [order.index(e) for e in range(fp.LEVELS + 1)]


def brute_chain(text: str, rank) -> list[tuple[int, set[int]]]:
    """(features, set bits) per filter, window by window."""
    data = text.encode()
    n = len(data) - fp.WINDOW + 1
    if n < 1:
        windows = [data] if data else []
    else:
        places = [rank[level(data[i : i + fp.WINDOW])] for i in range(n)]
        votes = Counter()
        for low in range(-fp.VOTERS + 1, n):
            votes[min(range(max(low, 0), min(low + fp.VOTERS, n)), key=lambda i: (places[i], i))] += 1
        windows = [data[i : i + fp.WINDOW] for i in sorted(votes) if votes[i] >= fp.VOTES]
    chain, seen = [], set()
    for w in windows:
        if w in seen:
            continue
        if len(seen) % fp.FILTER_FEATURES == 0:
            chain.append([0, set()])
        seen.add(w)
        h = mix(np.array([len(w) + 1], np.uint64))
        for word in np.frombuffer(w.ljust(fp.WINDOW, b"\0"), "<u8"):
            h = mix(h ^ word)
        chain[-1][0] += 1
        chain[-1][1].update(int(h[0]) >> (k * fp.HASH_BITS) & (fp.FILTER_BITS - 1) for k in range(fp.HASHES))
    return [tuple(c) for c in chain]


def brute_likeness(a, b) -> float:
    if not a or not b:
        return float(len(a) == len(b))

    def score(x, y):
        chance = len(x) * len(y) / fp.FILTER_BITS
        s = (len(x & y) - chance) / (min(len(x), len(y)) - chance)
        return s if s > fp.NOISE else 0.0

    def one_way(a, b):
        return sum(n * max(score(x, y) for _, y in b) for n, x in a) / sum(n for n, _ in a)

    na, nb = sum(n for n, _ in a), sum(n for n, _ in b)
    return one_way(a, b) if na < nb else one_way(b, a) if nb < na else (one_way(a, b) + one_way(b, a)) / 2


def bits_of(fingerprint: str):
    counts, filters = fp.parse(fingerprint)
    return [(int(n), set(np.flatnonzero(np.unpackbits(f)).tolist())) for n, f in zip(counts, filters)]


def shown(chain):
    return str([(n, sorted(bits)) for n, bits in chain])


def in_order(rows, spark):
    """(id, text) ascending by id (null first), equal ids by Spark's hash of the text, which has no meaning of its own."""
    frame = spark.createDataFrame([(i, t or "") for i, t in rows], "doc_id long, text string")
    hashed = frame.selectExpr("doc_id", "text", "xxhash64(text) AS h").collect()
    return [(r[0], r[1]) for r in sorted(hashed, key=lambda r: (r[0] is not None, r[0] or 0, r[2]))]


def check(docs, spark, chains=True):
    rows = in_order([tuple(r) for r in docs.select("doc_id", "text").collect()], spark)
    rank = fp.rarity(docs)
    assert rank.tolist() == brute_rank([t for _, t in rows])
    got = [tuple(r) for r in fp.compare_neighbours(docs, rank).select(*COLUMNS).collect()]
    assert len(got) == len(rows)
    want = Counter()
    memo = {}

    def chain(t):
        if t not in memo:
            memo[t] = brute_chain(t, rank.tolist())
        return memo[t]

    for k, (i, t) in enumerate(rows):
        following = rows[(k + 1) % len(rows)][1]
        half = len(t) // 2
        edited = t[: len(t) - half] + following[:half]
        near = [round(brute_likeness(chain(t), chain(o)), 4) for o in (edited, following)]
        want[(i, len(t), hashlib.sha256(edited.encode()).hexdigest(), shown(chain(t)), shown(chain(edited)), *near)] += 1
    have = Counter((i, n, sha, shown(bits_of(f)), shown(bits_of(e)), round(x, 4), round(y, 4)) for i, n, sha, f, e, x, y in got)
    assert have == want
    return got


def test_edge_rows(edge, spark):
    """Nulls, empty and very long texts, repeated rows and ids, clashing names, against windows counted one by one."""
    docs = edge.filter("text IS NULL OR length(text) < 20000")
    check(docs, spark)
    long_ = edge.filter("length(text) >= 20000")
    assert {r[1] for r in tuples(fp.compare_neighbours(long_, fp.rarity(long_)), "doc_id", "n_chars")} == {len(r["text"]) for r in long_.collect()}


def test_one_row_is_its_own_next(spark):
    docs = spark.createDataFrame([(3, "only one of its kind, and long enough for a few windows of bytes")], "doc_id long, text string")
    assert check(docs, spark)[0][-1] == 1.0


def test_an_empty_table(none):
    assert fp.compare_neighbours(none, fp.rarity(none)).collect() == []


def test_a_third_of_all_rows_is_one_row(spark):
    """Repeated rows follow each other: all but the last have themselves as next document."""
    rows = [(i, f"text number {i} " + "abc def ghi jkl " * (i % 7)) for i in range(60)] + [(30, "the same row again and again " * 4)] * 3000
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = check(docs, spark)
    assert sum(r[-1] == 1.0 and r[0] == 30 for r in got) >= 2999


def test_pieces_are_seamless(monkeypatch, spark):
    """The same chains whatever the number of windows worked on at once."""
    texts = [" ".join(f"w{(i * i + k) % 91}" for i in range(n)) for k, n in enumerate((3, 40, 900, 5000))]
    rank = np.arange(fp.LEVELS + 1)[::-1].copy()
    whole = fp.Chains([t.encode() for t in texts], rank)
    monkeypatch.setattr(fp, "CHUNK", 97)
    pieces = fp.Chains([t.encode() for t in texts], rank)
    assert [whole.text(i) for i in range(4)] == [pieces.text(i) for i in range(4)]
    assert bits_of(whole.text(2)) == brute_chain(texts[2], rank.tolist())


@pytest.mark.parametrize("sf_rows", [200])
def test_query_and_its_separation(sf, spark, sf_rows):
    """Equal texts have equal fingerprints; the edited half is found and strangers are not."""
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    got = QUERIES["op12_fingerprints"](spark, sf).collect()
    assert len(got) == docs.count() == sf_rows
    texts = {r["doc_id"]: r["text"] or "" for r in docs.collect()}
    by_text = {}
    for r in got:
        by_text.setdefault(texts[r["doc_id"]], set()).add(r["fingerprint"])
    assert all(len(f) == 1 for f in by_text.values())
    long_ = [r for r in got if r["n_chars"] >= 300]
    assert np.quantile([r["near_edited"] for r in long_], 0.05) > 0.3
    ids = sorted(texts)
    strangers = [r["near_next"] for r in long_ if len(set(texts[r["doc_id"]].split()) & set(texts[ids[(ids.index(r["doc_id"]) + 1) % len(ids)]].split())) < 20]
    assert np.quantile(strangers, 0.9) < 0.1
    alone = {r["doc_id"]: r["fingerprint"] for r in fp.fingerprints(docs, fp.rarity(docs)).collect()}
    assert all(alone[r["doc_id"]] == r["fingerprint"] for r in got)
