from __future__ import annotations

import hashlib
import random
import re
import zlib

import pytest

from zonelake.llm import prefix_trie
from zonelake.llm.queries import QUERIES

from .conftest import tuples

COLUMNS = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")
SCHEMA = "conv_id long, turn long, role string, text string, names string, words string, conv string, part string, at string, lo string, pos string, last string, task string"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def brute(rows):
    """The contract on plain lists; a row is (conv_id, turn, role, text), without equal turns of different text."""
    turns = {}
    for c, turn, role, text in rows:
        if c is not None:
            turns.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    turns = {c: [t[2:] for t in sorted(ts)] for c, ts in turns.items()}
    built = {}
    for c, own in turns.items():
        h = zlib.crc32(str(c).encode()) % 4
        built[c] = turns.get(c - (abs(c) % 20 if c >= 0 else -(abs(c) % 20)), [])[:h] + own[h:]
    members, kids = {}, {}
    for c in sorted(built):
        for d in range(len(built[c]) + 1):
            node = tuple(built[c][:d])
            members.setdefault(node, []).append(c)
            if d:
                kids.setdefault(node[:-1], set()).add(node)
    leaves, saved = {}, {}
    for node in sorted(members, key=len, reverse=True):
        below = kids.get(node, ())
        leaves[node] = sum(leaves[k] for k in below) or 1
        words = len(re.findall(r"[^\x20\x09-\x0D]+", node[-1][1])) if node else 0
        saved[node] = (len(members[node]) - 1) * words + sum(saved[k] for k in below)
    out = []
    for node, cs in members.items():
        ends = ",".join(str(c) for c in cs if len(built[c]) == len(node))
        up = members[node[:-1]][0] if node else None
        out.append((cs[0], len(node), up, len(cs), len(kids.get(node, ())), leaves[node], saved[node], sha(ends)))
    return sorted(out, key=lambda t: tuple((v is not None, v) for v in t))


def frame(spark, rows, parts=3):
    return spark.createDataFrame([(*r, *["x"] * 9) for r in rows], SCHEMA).repartition(parts)


def check(spark, rows, **options):
    got = tuples(prefix_trie.build_trie(frame(spark, rows), **options), *COLUMNS)
    assert got == brute(rows)
    return got


EDGE = [
    (None, 1, "user", "nobody's"),
    (0, 2, "user", "third"),
    (0, None, "user", "first"),
    (0, 1, None, "second  words\there"),
    (0, 1, None, "second  words\there"),  # a repeated row is a turn
    (1, 1, "user", None),
    (1, 2, None, ""),
    (3, 1, "user", "x"),
    (-7, 1, "user", "x"),
    (-20, 1, "user", "y z"),
    (-20, 2, "user", "y z"),
    (41, 5, "user", "no head here"),
    (41, 6, "a", "b"),
    (5_000_000_007, 1, "user", "big \U0001f642 id"),
    (47, 1, "us", "erx"),
    (48, 1, "user", "x"),
    *[(60 + i, t, "user", f"turn {t}") for i in range(12) for t in range(i)],
    (100, 1, "user", "word " * 50_000),
    (101, 1, "user", "word " * 50_000),
]


@pytest.mark.parametrize("fan", [2, 64])
def test_edge_rows(spark, fan):
    """Nulls, ties, repeated rows, clashing names, turnless and headless conversations, whatever the number of rounds."""
    assert any(r[1] == 0 for r in check(spark, EDGE, fan=fan))


def test_an_empty_table_has_no_node(spark):
    assert prefix_trie.build_trie(frame(spark, EDGE).limit(0)).collect() == []
    assert prefix_trie.build_trie(frame(spark, [(None, 1, "a", "b")])).collect() == []


@pytest.mark.parametrize("seed,shallow,fan", [(1, 1, 2), (2, 2, 3), (3, 64, 2)])
def test_random_conversations(spark, seed, shallow, fan):
    """Few different turns, so that many prefixes are shared at all depths; long tails beyond ``shallow`` are streamed."""
    rng = random.Random(seed)
    rows = []
    for c in rng.sample(range(400), 150):
        for t in range(rng.choice([1, 2, 4, 9, 40])):
            rows.append((c, t, "user" if t % 2 else None, rng.choice(["a", "a", "a b c", "d"])))
    check(spark, rows, shallow=shallow, fan=fan)


def test_groups_of_copies_and_one_very_long_conversation(spark):
    """A third of all conversations are copies; one conversation holds a third of all turns."""
    rows = [(20 * i, t, "user", f"same {t}") for i in range(300) for t in range(4)]
    rows += [(20 * i + 1, t, "user", f"other {i} {t}") for i in range(300) for t in range(2)]
    rows += [(7, t, "user", f"t {t % 5}") for t in range(1500)]
    rows += [(8, t, "user", f"t {t % 5}" if t < 200 else "end") for t in range(260)]
    check(spark, rows)
    check(spark, rows, shallow=8, fan=2)


def test_digest_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "PIECE", 3)
    check(spark, [(20 * i, 0, "user", "same") for i in range(50)] + [(20 * i + 5, 0, "a", str(i % 3)) for i in range(30)])


def test_query_equals_the_contract(sf, spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert tuples(QUERIES["op13_prefix_trie"](spark, sf), *COLUMNS) == brute(rows)
