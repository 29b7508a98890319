"""Corpus pipeline: quality rules, line dedup, near-duplicate join, benchmark decontamination, SentencePiece ids.

Each stage takes (spark, docs, sf_dir), works on all rows that its predecessor kept and, but for the last, returns the columns
of ``docs``.  ``run`` writes every stage as Parquet in the shared folder and reads it again, so a lost executor costs tasks of
one stage only.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from zonelake.llm import decontaminate, lines, ngram_join, pieces, quality
from zonelake.llm.queries import vocabulary_file
from zonelake.session import checkpoint_dir


def _row(docs: DataFrame):
    """All columns in one, so that none clashes with those of an operator."""
    return F.struct(*[F.col(f"`{c}`") for c in docs.columns])


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the rules keep, as they are; the cutoffs are calibrated jointly, unlike those that the SQL of op10 fixes."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality.judge_quality(docs, labels, keep={"_row": _row(docs)}, joint=True).filter("kept").select("_row.*")


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, without lines of windows that occurred before (n_chars follows); none is dropped, some become empty."""
    cut = lines.duplicate_lines(docs, keep={"_row": _row(docs)})
    new = {"text": F.col("text"), "n_chars": F.when(F.col("n_removed") > 0, F.length("text").cast("long")).otherwise(F.col("_row.n_chars"))}
    return cut.select(*[new.get(c, F.col(f"_row.`{c}`")).alias(c) for c in docs.columns])


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of the least id of every near-duplicate class.  Texts without words (null, empty, or emptied by the line stage)
    are equal, so they are one class here; documents without an id stay."""
    gone = ngram_join.near_duplicates(docs).filter("doc_id <> class_id").select("doc_id").distinct()
    wordless = ~F.coalesce(F.col("text").rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    least = docs.filter(wordless).agg(F.min("doc_id")).first()[0]
    one = ~wordless | F.col("doc_id").isNull() | (F.col("doc_id") == F.lit(least))
    return docs.filter(F.coalesce(one, F.lit(True))).join(gone, "doc_id", "left_anti").select(docs.columns)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents in which no benchmark item leaks."""
    return decontaminate.drop_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, ids, n_tokens) of every document."""
    vocabulary = pieces.load_vocabulary(str(vocabulary_file("piece_bpe_32k.model")))
    return pieces.encode(docs, vocabulary).select("doc_id", "ids", F.size("ids").cast("long").alias("n_tokens"))


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("ngram_join", near_duplicates),
    ("decontamination", decontamination),
    ("sentencepiece", sentencepiece),
]

#: SQL cannot express the verified join, the tiling or the encoding; tests compare with a brute-force version
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole ``documents`` table; the rows of the last one."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = f"{checkpoint_dir(spark)}/pipeline-{uuid.uuid4()}"
    for k, (name, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{k}-{name}")
        docs = spark.read.parquet(f"{folder}/{k}-{name}")
    return docs
