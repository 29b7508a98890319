"""Line and substring dedup against brute force, on edge cases and on a small table."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from tests.llm.conftest import ROWS, tuples
from zonelake.llm import lines, substring

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def in_order(rows):
    """Documents by id (null first) and text; equal rows once."""
    return sorted(set(rows), key=lambda r: (r[0] is not None, r[0], r[1] or ""))


def brute_lines(rows):
    seen, out = {}, {}
    for i, text in in_order(rows):
        parts, cut = (text or "").split("\n"), set()
        for k in range(len(parts) - 2):
            window, place = tuple(parts[k : k + 3]), (i, k)
            if seen.setdefault(window, place) != place:
                cut |= {k, k + 1, k + 2}
        kept = None if text is None else "\n".join(p for k, p in enumerate(parts) if k not in cut)
        out[(i, text)] = (i, kept, 0 if text is None else len(parts), len(cut))
    return sorted((out[r] for r in rows), key=lambda t: tuple((v is not None, v) for v in t))


def brute_words(rows):
    seen, out = set(), {}
    for i, text in in_order(rows):
        words = WORD.findall(text or "")
        gone = set()
        for k in range(len(words) - 19):
            window = tuple(words[k : k + 20])
            if window in seen:
                gone.update(range(k, k + 20))
            seen.add(window)
        out[(i, text)] = (i, len(words), len(gone), " ".join(w for k, w in enumerate(words) if k not in gone))
    return sorted((out[r] for r in rows), key=lambda t: tuple((v is not None, v) for v in t))


def rows_of(frame):
    return [(r.doc_id, r.text) for r in frame.select("doc_id", "text").collect()]


def test_lines_edge(edge):
    assert tuples(lines.duplicate_lines(edge), "doc_id", "text", "n_lines", "n_removed") == brute_lines(ROWS)


def test_lines_overlap(spark):
    rows = [(1, "a\nb\nc\nd\ne"), (2, "b\nc\nd\ne\nf"), (3, "e\nf\ng"), (4, "z\nz\nz\nz\nz"), (5, "z\nz\nz")]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    assert tuples(lines.duplicate_lines(frame), "doc_id", "text", "n_lines", "n_removed") == brute_lines(rows)


def test_lines_keep_columns(edge):
    kept = lines.duplicate_lines(edge, keep={"_row": F.struct("source", "key")})
    assert kept.columns == ["doc_id", "text", "n_lines", "n_removed", "_row"]
    assert kept.count() == len(ROWS)


def test_words_edge(edge):
    """Equal ids with unlike texts don't occur here: their order is by hash."""
    got = tuples(substring.remove_repeats(edge), "doc_id", "n_words", "n_removed", "text")
    by_null = [r for r in ROWS if r[0] is not None or r[1] is None or "no id" in r[1]]
    assert got == brute_words(by_null)


def test_words_of_equal_id_each_keep_one_order(spark):
    passage = " ".join(f"p{i}" for i in range(25))
    rows = [(1, f"{passage} x"), (1, f"{passage} y"), (1, f"{passage} y"), (2, passage)]
    got = tuples(substring.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")), "doc_id", "n_words", "n_removed")
    assert sorted(got) in ([(1, 26, 0), (1, 26, 25), (1, 26, 25), (2, 25, 25)], [(1, 26, 0), (1, 26, 0), (1, 26, 25), (2, 25, 25)])


@pytest.mark.parametrize("bits", [3 << 3, 1 << 28])
def test_words_with_any_bit_table(edge, monkeypatch, bits):
    """A table too small to skip anything changes nothing."""
    monkeypatch.setattr(substring, "MAX_BITS", bits)
    got = tuples(substring.remove_repeats(edge), "doc_id", "n_words", "n_removed", "text")
    assert got == brute_words(ROWS)


def test_small_table(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = rows_of(docs)
    assert tuples(substring.remove_repeats(docs), "doc_id", "n_words", "n_removed", "text") == brute_words(rows)
    assert tuples(lines.duplicate_lines(docs), "doc_id", "text", "n_lines", "n_removed") == brute_lines(rows)


def test_empty(none):
    assert substring.remove_repeats(none).collect() == []
    assert lines.duplicate_lines(none).collect() == []
