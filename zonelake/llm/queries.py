"""Registered queries of the training-data operators, each over its whole table, and their SQL."""

from __future__ import annotations

import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import checkpoint_dir
from . import decontaminate, fingerprints, html_text, lines, merkle, ngram_join, pieces, prefix_trie, quality, sharding, substring, token_files, urls
from .oracles import ORACLE_SQL  # noqa: F401


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def vocabulary_file(name: str) -> Path:
    import public_tokenizers

    return Path(public_tokenizers.path(name))


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(_table(spark, sf_dir, "documents"), 8)


def op2_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.filter_urls(_table(spark, sf_dir, "pages"))


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge_quality(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op3_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.near_duplicates(_table(spark, sf_dir, "documents"))


def op4_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocabulary = pieces.load_vocabulary(str(vocabulary_file("piece_bpe_32k.model")))
    encoded = pieces.encode(_table(spark, sf_dir, "documents"), vocabulary, decoded=True)
    return encoded.select("doc_id", "ids", F.size("ids").cast("long").alias("n_tokens"), F.crc32("decoded").alias("decoded_crc32"))


def op5_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.main_text(_table(spark, sf_dir, "pages"))


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find_leaks(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.duplicate_lines(_table(spark, sf_dir, "documents"))


def op8_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{checkpoint_dir(spark)}/token-files-{uuid.uuid4()}"  # shared by all executors
    token_files.write_tokens(_table(spark, sf_dir, "documents"), path, vocabulary_file("word_bpe_49k.json").read_text())
    return token_files.read_index(spark, path)


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = substring.remove_repeats(_table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{checkpoint_dir(spark)}/manifest-{uuid.uuid4()}"  # shared by all executors
    leaf = merkle.digest(*[F.col(c) for c in merkle.LEAF])
    manifest = merkle.build_manifest(_table(spark, sf_dir, "documents"), path, leaf, merkle.tampered_leaf())
    return merkle.verify(manifest).withColumnRenamed("id", "doc_id")


def op12_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return fingerprints.compare_neighbours(docs, fingerprints.rarity(docs))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.build_trie(_table(spark, sf_dir, "conversations"))


QUERIES = {
    "op1_sharding": op1_sharding,
    "op2_url_filters": op2_url_filters,
    "op3_ngram_join": op3_ngram_join,
    "op4_sentencepiece": op4_sentencepiece,
    "op5_html_extraction": op5_html_extraction,
    "op6_decontamination": op6_decontamination,
    "op7_line_dedup": op7_line_dedup,
    "op8_token_files": op8_token_files,
    "op9_substring_dedup": op9_substring_dedup,
    "op10_quality_rules": op10_quality_rules,
    "op11_merkle_manifest": op11_merkle_manifest,
    "op12_fingerprints": op12_fingerprints,
    "op13_prefix_trie": op13_prefix_trie,
}
