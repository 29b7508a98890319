"""The pipeline's stages, one by one, and the registered queries against their SQL."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tests.llm.conftest import ROWS, tuples
from tests.llm.test_pairs_tokens import brute_duplicates
from tests.llm.test_lines_substring import brute_lines
from tools.check_oracle import compare
from zonelake.llm.queries import ORACLE_SQL, QUERIES


def test_queries_match_their_sql(spark, sf):
    failed = [r for r in compare(spark, sf, list(ORACLE_SQL)) if not r["ok"]]
    assert not failed, failed
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, 14))


def test_stages(spark, sf, tmp_path):
    """Each stage on what its predecessor kept, against the brute-force versions of its operator."""
    from zonelake.llm import decontaminate, quality

    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns = docs.columns
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["quality_rules", "line_dedup", "ngram_join", "decontamination", "sentencepiece"]

    def stored(name, frame):
        frame.write.parquet(str(tmp_path / name))
        return spark.read.parquet(str(tmp_path / name))

    kept = stored("q", stages["quality_rules"](spark, docs, sf))
    judged = quality.judge_quality(docs, spark.read.parquet(f"{sf}/labels.parquet"))
    assert kept.columns == columns
    assert tuples(kept, *columns) == tuples(docs.join(judged.where("kept").select("doc_id"), "doc_id"), *columns)

    cut = stored("l", stages["line_dedup"](spark, kept, sf))
    rows = [(r.doc_id, r.text) for r in kept.collect()]
    assert cut.columns == columns
    assert tuples(cut, "doc_id", "text") == [(i, t) for i, t, _, _ in brute_lines(rows)]
    assert cut.where(F.length("text") != F.col("n_chars")).count() == 0

    single = stored("n", stages["ngram_join"](spark, cut, sf))
    classes = brute_duplicates([(r.doc_id, r.text) for r in cut.collect()])
    assert single.columns == columns
    empty = sorted(r.doc_id for r in cut.collect() if not (r.text or "").strip(" \t\n\x0b\x0c\r"))  # one class: equal texts
    assert sorted(r.doc_id for r in single.collect()) == sorted(i for i, (c, _) in classes.items() if c == i and i not in empty[1:])

    clean = stored("d", stages["decontamination"](spark, single, sf))
    leaks = {r.doc_id for r in decontaminate.find_leaks(single, spark.read.parquet(f"{sf}/benchmark.parquet")).collect()}
    assert sorted(r.doc_id for r in clean.collect()) == sorted(r.doc_id for r in single.collect() if r.doc_id not in leaks)

    ids = stages["sentencepiece"](spark, clean, sf)
    assert ids.count() == clean.count()
    final = corpus_pipeline.run(spark, sf)
    assert tuples(final, "doc_id", "n_tokens") == tuples(ids, "doc_id", "n_tokens")


def test_wordless_texts_are_one_class(spark, sf):
    rows = [(5, ""), (3, " \n"), (9, None), (None, ""), (None, None), (3, ""), (4, "two words"), (6, "\u3000")]
    out = dict(corpus_pipeline.STAGES)["ngram_join"](spark, spark.createDataFrame(rows, "doc_id long, text string"), sf)
    assert tuples(out, "doc_id", "text") == [(None, None), (None, ""), (3, ""), (3, " \n"), (4, "two words"), (6, "\u3000")]


@pytest.mark.parametrize("name", [name for name, _ in corpus_pipeline.STAGES])
def test_stages_on_odd_rows(spark, edge, none, sf, name):
    stage = dict(corpus_pipeline.STAGES)[name]
    out = stage(spark, edge, sf)
    if name != "sentencepiece":
        assert out.columns == edge.columns
    if name in ("line_dedup", "sentencepiece", "decontamination"):
        assert out.count() == len(ROWS)
    assert stage(spark, none, sf).count() == 0
