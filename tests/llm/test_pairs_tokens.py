"""Near-duplicate join, decontamination, token files and SentencePiece against brute force, round trips and the libraries."""

from __future__ import annotations

import random
import re
import zlib
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tests.llm.conftest import ROWS, tuples
from zonelake.llm import components, decontaminate, ngram_join, pieces, token_files
from zonelake.llm.queries import vocabulary_file

WORD = re.compile(r"[^\x20\x09-\x0D]+")


# --- near duplicates


def grams(text):
    words = WORD.findall(text or "")
    return frozenset(tuple(words[i : i + 5]) for i in range(max(len(words) - 4, 1))) if words else frozenset()


def brute_duplicates(rows):
    """rows with different ids -> {id: (class, links)}."""
    sets = {i: grams(t) for i, t in rows}
    links = {i: [j for j in sets if j != i and sets[i] & sets[j] and 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j])] for i in sets}
    out = {}
    for i in sets:
        seen, todo = {i}, [i]
        while todo:
            for j in links[todo.pop()]:
                if j not in seen:
                    seen.add(j)
                    todo.append(j)
        out[i] = (min(seen), len(links[i]))
    return out


def variants(seed=1):
    """Texts with many near copies of each other, chains and clean ones."""
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(300)]
    rows = []
    for group in range(6):
        base = [rng.choice(vocabulary) for _ in range(rng.choice((6, 40, 150)))]
        for _ in range(rng.choice((1, 2, 12, 25))):
            text = list(base)
            for _ in range(rng.randrange(4)):
                text[rng.randrange(len(text))] = rng.choice(vocabulary)
            rows.append((len(rows), " ".join(text)))
            if rng.random() < 0.3:
                base = text  # a chain
    rows += [(len(rows) + k, t) for k, t in enumerate(["one two", "one two", "one  two", "x", "", None, "a b c d", "a b c d e"])]
    return rows


@pytest.mark.parametrize("block", [512, 4])
def test_duplicates(spark, monkeypatch, block):
    monkeypatch.setattr(ngram_join, "BLOCK_TEXTS", block)
    rows = variants()
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = {r.doc_id: (r.class_id, r.n_links) for r in ngram_join.near_duplicates(frame).collect()}
    assert got == brute_duplicates(rows)


def test_duplicates_small_table(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    got = {r.doc_id: (r.class_id, r.n_links) for r in ngram_join.near_duplicates(docs).collect()}
    assert got == brute_duplicates(rows)


def test_duplicates_edge(edge, none):
    got = tuples(ngram_join.near_duplicates(edge), "doc_id", "class_id", "n_links")
    assert [g[:1] for g in got] == sorted([(i,) for i, _ in ROWS], key=lambda t: tuple((v is not None, v) for v in t))
    assert all(c is None and n == 0 for i, c, n in got if i is None)
    assert {(i, c) for i, c, _ in got if i in (3, 4, 5, 6)} == {(3, 3), (4, 4), (5, 5), (6, -7)}
    assert {n for i, _, n in got if i == 2} == {3}  # the repeated row and documents 0 and 1
    assert ngram_join.near_duplicates(none).collect() == []


def brute_rows(rows):
    """Rows of any ids -> sorted (id, class, links): links to other rows, versions of an id in one class."""
    sets = [grams(t) for _, t in rows]
    n = len(rows)
    linked = [[j for j in range(n) if j != i and sets[i] & sets[j] and 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j])] for i in range(n)]
    out = []
    for i in range(n):
        seen, todo = {i}, [i]
        while todo:
            k = todo.pop()
            for j in [*linked[k], *(j for j in range(n) if sets[k] and sets[j] and rows[j][0] == rows[k][0])]:
                if j not in seen:
                    seen.add(j)
                    todo.append(j)
        out.append((rows[i][0], min(rows[j][0] for j in seen), len(linked[i])))
    return sorted(out)


@pytest.mark.parametrize("block", [512, 3])
def test_duplicates_repeated_ids(spark, monkeypatch, block):
    """Repeated rows and versions of one id, also where the id is the least of its class."""
    monkeypatch.setattr(ngram_join, "BLOCK_TEXTS", block)
    a = " ".join(f"w{i}" for i in range(60))
    rows = [(1, a), (1, a), (2, a + " tail"), (3, "something else entirely different here")]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert tuples(ngram_join.near_duplicates(frame), "doc_id", "class_id", "n_links") == [(1, 1, 2), (1, 1, 2), (2, 1, 2), (3, 3, 0)]
    rng = random.Random(4)
    some = [t for _, t in variants(2)]
    rows = [(rng.randrange(40), rng.choice(some)) for _ in range(150)] + [(-3, some[0])] * 20
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert tuples(ngram_join.near_duplicates(frame), "doc_id", "class_id", "n_links") == brute_rows(rows)


def test_choose_bands():
    for similarity, recall in ((0.8, 0.9999), (0.5, 0.9), (0.95, 0.999)):
        bands, rows = ngram_join.choose_bands(similarity, recall)
        assert 1 - (1 - similarity**rows) ** bands >= recall and bands * rows <= ngram_join.MAX_HASHES
        more = rows + 1
        need = np.ceil(np.log(1 - recall) / np.log(1 - similarity**more))
        assert need * more > ngram_join.MAX_HASHES
    assert ngram_join.SIMILARITY == Fraction(4, 5)


def test_components(spark):
    rng = random.Random(5)
    links = [(rng.randrange(200), rng.randrange(200)) for _ in range(130)] + [(300 + i, 301 + i) for i in range(40)] + [(7, 7)]
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in links:
        if a != b:
            a, b = sorted((find(a), find(b)))
            parent[b] = a
    got = {r.node: r.component for r in components.connected_components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {x: find(x) for x in parent}
    assert components.connected_components(spark.createDataFrame([], "a long, b long")).collect() == []


# --- decontamination


def plain_tiles(doc, item, least=5):
    """Greedy string tiling as it is defined, on short lists."""
    marked = [[False] * len(doc), [False] * len(item)]
    covered = tiles = 0
    while True:
        best, found = least - 1, []
        for j in range(len(item)):
            for i in range(len(doc)):
                n = 0
                while i + n < len(doc) and j + n < len(item) and doc[i + n] == item[j + n] and not marked[0][i + n] and not marked[1][j + n]:
                    n += 1
                if n > best:
                    best, found = n, [(i, j)]
                elif n == best and n >= least:
                    found.append((i, j))
        if best < least:
            return covered, tiles
        for i, j in found:
            if not any(marked[0][i : i + best]) and not any(marked[1][j : j + best]):
                marked[0][i : i + best] = marked[1][j : j + best] = [True] * best
                covered, tiles = covered + best, tiles + 1


def test_tiling_is_the_plain_one():
    rng = random.Random(3)
    for _ in range(150):
        doc = [rng.randrange(5) for _ in range(rng.randrange(60))]
        item = [rng.randrange(5) for _ in range(rng.randrange(30))]
        if rng.random() < 0.5 and len(item) > 12:
            doc[5:5] = item[8:] + [9] + item[:8]  # reordered
        hashed = [np.array([x * 0x9E3779B97F4A7C15 % 2**64 for x in s], np.uint64) for s in (doc, item)]
        assert decontaminate.tile(*hashed) == plain_tiles(doc, item)


@pytest.mark.parametrize("bound", [decontaminate.MAX_SEEDS, 0])
def test_short_items(spark, monkeypatch, bound):
    """Items of one to four words leak where all of them stand side by side."""
    monkeypatch.setattr(decontaminate, "MAX_SEEDS", bound)
    items = [(1, "Zebra!"), (2, "green ideas"), (3, "colourless green ideas"), (4, "one two three four"), (5, ""), (6, "..."), (7, "a b c d e f")]
    docs = [(1, "a zebra, and Green  ideas."), (2, "green new ideas"), (3, "so colourless green ideas sleep"), (4, "one two three"), (5, "x one-two one two, three; FOUR"), (6, None), (7, "a b c d e")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    got = tuples(decontaminate.find_leaks(frame, bench), "doc_id", "item_id", "n_item_words", "n_covered", "n_tiles")
    assert got == [(1, 1, 1, 1, 1), (1, 2, 2, 2, 1), (3, 2, 2, 2, 1), (3, 3, 3, 3, 1), (5, 4, 4, 4, 1), (7, 7, 6, 5, 1)]
    assert tuples(decontaminate.drop_leaks(frame, bench), "doc_id") == [(2,), (4,), (6,)]


def test_a_very_long_document_meets_many_items():
    """A million words and 600 items in seconds: the document is hashed once and looked at around its seeds only."""
    import time

    rng = random.Random(8)
    words = [f"w{i}" for i in range(3000)]
    items = [" ".join(rng.choice(words) for _ in range(40)) for _ in range(600)]
    text = [rng.choice(words) for _ in range(1_000_000)]
    for k in range(0, 600, 2):
        item = items[k].split()
        text[k * 1500 : k * 1500 + 40] = item[20:] + item[:20]
    index = decontaminate._index(pa.table({"text": items}))
    begin = time.time()
    found = decontaminate._leaks_of(pa.RecordBatch.from_pydict({"text": [" ".join(text)]}), index, 0.5)
    assert time.time() - begin < 30
    assert [f[1] for f in found] == list(range(0, 600, 2)) and all(f[3] == 40 and f[4] == 2 for f in found)


@pytest.mark.parametrize("bound", [decontaminate.MAX_SEEDS, 0])
def test_leaks(spark, edge, none, monkeypatch, bound):
    """Whole, edited, reordered and partial passages, by broadcast and by join."""
    monkeypatch.setattr(decontaminate, "MAX_SEEDS", bound)
    words = [f"q{i}" for i in range(30)]
    item = " ".join(words)
    texts = {
        1: f"before {item} after",
        2: "x " + " ".join(words[15:] + ["y"] + words[:15]),
        3: " ".join(w.upper() + "," for w in words),
        4: " ".join(w if i % 10 else "changed" for i, w in enumerate(words)),
        5: " ".join(words[:12]),
        6: " ".join(w for pair in zip(words, ["z"] * 30) for w in pair),
        7: "", 8: None, 9: f"{item} {item}",
    }
    rows = [*texts.items(), (None, item), (1, texts[1])]
    docs = spark.createDataFrame([(i, t, "x", "y") for i, t in rows], "doc_id long, text string, item string, seed string")
    bench = spark.createDataFrame([(0, item, "x"), (1, "too short to find", "x"), (2, None, "x"), (None, "", "x")], "item_id long, text string, doc_id string")
    got = tuples(decontaminate.find_leaks(docs, bench), "doc_id", "item_id", "n_item_words", "n_covered", "n_tiles")
    assert got == [(None, 0, 30, 30, 1), (1, 0, 30, 30, 1), (1, 0, 30, 30, 1), (2, 0, 30, 30, 2), (3, 0, 30, 30, 1), (4, 0, 30, 27, 3), (9, 0, 30, 30, 1)]
    kept = decontaminate.drop_leaks(docs, bench)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [5, 6, 7, 8]
    assert decontaminate.find_leaks(docs, bench.limit(0)).collect() == []
    assert decontaminate.find_leaks(none, bench).collect() == []
    assert decontaminate.drop_leaks(edge, bench).count() == len(ROWS)


# --- token files


def test_elias_fano():
    rng = np.random.default_rng(0)
    for n in (1, 2, 63, 64, 65, 1000):
        for step in (1, 3, 50, 100_000):
            values = np.sort(rng.integers(0, step * n, n))
            bits, low, high, sample = token_files.elias_fano(values)
            read = token_files.EliasFano(n, bits, low, high, sample)
            assert (read.all() == values).all()
            assert [read.select(k) for k in range(n)] == values.tolist()
            assert 8 * (len(low) + len(high)) <= n * (2 + max(0, np.log2(max(step, 1)))) + n + 24
    assert token_files.EliasFano(0, *token_files.elias_fano(np.zeros(0, np.int64))).all().tolist() == []


def library_index(rows, tokenizer):
    out, start = [], 0
    for i, text in sorted(rows, key=lambda r: (r[0] is not None, r[0])):
        ids = np.array(tokenizer.encode(text or "", add_special_tokens=False).ids + [1], "<u4")
        out.append((i, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return out


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_token_files(spark, edge, tmp_path, monkeypatch, name):
    """By words, and with whole texts for a tokenizer of other rules."""
    from tokenizers import Tokenizer

    text = vocabulary_file(name).read_text()
    assert token_files.by_word(text) == (name == "word_bpe_49k.json")
    monkeypatch.setattr(token_files, "SEGMENT_BYTES", 2000)
    token_files.write_tokens(edge, str(tmp_path / "t"), text)
    got = [tuple(r) for r in token_files.read_index(spark, str(tmp_path / "t")).select("doc_id", "start", "n_tokens", "ids_crc32").collect()]
    want = library_index(ROWS, Tokenizer.from_str(text))
    strip = lambda rows: sorted(((i, n, c) for i, _, n, c in rows), key=str)  # noqa: E731  rows of one id stand in the order of a hash
    assert strip(got) == strip(want)
    by_start = sorted(got, key=lambda r: r[1])
    assert [r[0] for r in by_start] == [r[0] for r in want]
    assert [r[1] for r in by_start] == np.concatenate([[0], np.cumsum([r[2] for r in by_start])[:-1]]).tolist()
    ids = token_files.read_tokens(spark, str(tmp_path / "t")).collect()
    assert sorted(zlib.crc32(np.array(r.ids, "<u4").tobytes()) for r in ids) == sorted(r[3] for r in want)


def test_token_files_small_table(spark, sf, none, tmp_path):
    from tokenizers import Tokenizer

    text = vocabulary_file("word_bpe_49k.json").read_text()
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    token_files.write_tokens(docs, str(tmp_path / "t"), text)
    want = library_index([(r.doc_id, r.text) for r in docs.collect()], Tokenizer.from_str(text))
    assert tuples(token_files.read_index(spark, str(tmp_path / "t")), "doc_id", "start", "n_tokens", "ids_crc32") == want
    token_files.write_tokens(none, str(tmp_path / "none"), text)
    assert token_files.read_index(spark, str(tmp_path / "none")).collect() == []


# --- SentencePiece

TEXTS = [
    "a  b", "  a b ", "a\tb\nc", "ﬁ Ａ", "", " x", "a　b", "x\r\ny", "€🙂▁q", "    hello    world   ", "\n\n", "🙂🙂  🙂", "<0x0A> <s> </s> <unk>", "aaaaaaaaaaaa",
    "\x00z\x00", "日本語 テスト    です", " " * 17 + "x", "é́ñ", "x" * 300, "▁▁a", "The quick brown fox's 12,345 jumps!", "don't  stop\t\tnow ",
]


@pytest.fixture(scope="module")
def vocabulary():
    return pieces.load_vocabulary(str(vocabulary_file("piece_bpe_32k.model")))


def check_pieces(frame, vocabulary, rows):
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=str(vocabulary_file("piece_bpe_32k.model")))
    got = pieces.encode(frame, vocabulary, decoded=True, keep=("extra",) if "extra" in frame.columns else ()).collect()
    want = sorted(((i, model.encode(t or ""), model.decode(model.encode(t or ""))) for i, t in rows), key=str)
    assert sorted(((r.doc_id, r.ids, r.decoded) for r in got), key=str) == want


def test_long_units_are_the_library(vocabulary):
    """Time and memory in proportion to a unit: a million spaces, megabytes without a space, with and without safe borders."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=str(vocabulary_file("piece_bpe_32k.model")))
    rng = random.Random(3)
    letters = [chr(c) for c in range(33, 127)]
    texts = [
        "a" + " " * 1_000_000 + "b",
        " " * 70 + "x" + " " * 33,
        "a" * 300_000,
        "thetioning" * 30_000,
        "".join(rng.choice(letters) for _ in range(3_000_000)),
        "".join(rng.choice(["the", "ing", "\u65e5", "a", "Z", "\u00e9", "\U0001f642", "x0"]) for _ in range(100_000)),
        *["".join(rng.choice("abeint") for _ in range(n)) for n in (2040, 2050, 2100, 4100, 9000)],
        *["=" * n + " " * (n % 40) + "-" * n for n in range(2040, 2060, 3)],
    ]
    ids, starts = pieces._encode(pa.array([f" {t}" for t in texts]), pieces.Encoder(vocabulary))
    for text, a, b in zip(texts, starts, starts[1:]):
        assert ids[a:b].tolist() == model.encode(text)


def test_pieces_are_the_library(spark, edge, none, sf, vocabulary, monkeypatch):
    rows = list(enumerate(TEXTS))
    frame = spark.createDataFrame([(i, t, i) for i, t in rows], "doc_id long, text string, extra long")
    check_pieces(frame, vocabulary, rows)
    check_pieces(edge, vocabulary, ROWS)
    assert pieces.encode(none, vocabulary).collect() == []
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    check_pieces(docs, vocabulary, [(r.doc_id, r.text) for r in docs.collect()])
    monkeypatch.setattr(pieces, "INDEX_BYTES", 50)
    monkeypatch.setattr(pieces, "CACHED_UNITS", 10)
    check_pieces(frame, vocabulary, rows)


def test_decode(spark, vocabulary):
    rows = [(1, [3 + 0xE2, 3 + 0x82, 3 + 0xAC]), (2, [3 + 0xFF]), (3, []), (4, None), (5, [1, 0, 2])]
    frame = spark.createDataFrame(rows, "doc_id long, ids array<int>")
    got = dict(tuples(pieces.decode(frame, vocabulary), "doc_id", "decoded"))
    assert got == {1: "€", 2: "�", 3: "", 4: None, 5: "⁇ "}


def test_decode_round_trip(spark, sf, vocabulary):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    both = pieces.decode(pieces.encode(docs, vocabulary, keep=("text",)), vocabulary)
    assert both.where(~F.col("decoded").eqNullSafe(F.col("text"))).count() == 0


def test_pair_table():
    table = pieces.PairTable()
    rng, known = np.random.default_rng(1), {}
    for _ in range(30):
        keys = rng.integers(0, 1 << 30, 4000)
        fits, found = table.get(keys)
        assert all(bool(f) == (k in known) and (not f or bool(v) == known[k]) for k, v, f in zip(keys.tolist(), fits, found))
        new = np.unique(keys[~found])
        values = rng.random(len(new)) < 0.5
        table.put(new, values)
        known.update(zip(new.tolist(), values.tolist()))
