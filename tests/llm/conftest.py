from __future__ import annotations

import pytest

LONG = " ".join(f"word{i % 997}" for i in range(30_000))
PASSAGE = " ".join(f"shared{i}" for i in range(40))

#: nulls, empty and very long texts, ties, repeated rows; the other columns clash with names that operators use
ROWS = [
    (0, f"alpha beta gamma {PASSAGE} delta"),
    (1, f"{PASSAGE} other words here"),
    (2, f"{PASSAGE} other words here"),
    (2, f"{PASSAGE} other words here"),
    (3, ""),
    (4, None),
    (None, f"no id {PASSAGE}"),
    (None, None),
    (5, " \t\n\x0b\x0c\r "),
    (6, LONG),
    (7, "a\nb\nc\nd\na\nb\nc"),
    (8, "a\nb\nc"),
    (9, "x y z x y z x y z"),
    (10, "Ünïcödé ß 日本語 🙂🙂 don't <|endoftext|> é İ Σς '9²  　 ▁▁ <0x0A> A\x00B"),
    (11, "same same same same " * 30),
    (5_000_000_000, "big id"),
    (-7, f"negative id {LONG}"),
]
CLASH = "id long, key string, size string, class string, part string, at string, shard string, slot string, dig string, head string, route string, d1 string, node string, bands string, task string, grams string, stratum string, _t string, _w string, _row string, _l string, n_words string, kept string, seed string, row string, ids string, page string, host string, html string, verdict string, rule string, item string"


@pytest.fixture(scope="session")
def edge(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long, " + CLASH
    extra = len(CLASH.split(", "))
    rows = [(i, t, None if k % 3 else "en", None, None, *[None if k % 2 else (k if j == 0 else "x") for j in range(extra)]) for k, (i, t) in enumerate(ROWS)]
    return spark.createDataFrame(rows, schema).repartition(3)


@pytest.fixture(scope="session")
def none(edge):
    return edge.limit(0)


@pytest.fixture(scope="session")
def sf(spark):
    import os

    path = "/root/testdata/sf0.001"
    if not os.path.isdir(path):
        pytest.skip("test tables not present")
    return path


def tuples(frame, *columns):
    return sorted((tuple(r[c] for c in columns) for r in frame.select(*columns).collect()), key=lambda t: tuple((v is not None, v) for v in t))
