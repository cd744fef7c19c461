"""Registered queries of this subpackage: one per operator, over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (bpe, collocations, exact_dedup, fm_index, html_extract, langid, merkle, mixing, ngram_join, prefix_trie, secrets, suffix_dedup,
               warc)
from .common import table

VOCABULARY = "byte_bpe_50k.tiktoken"


def op1_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path(VOCABULARY), public_tokenizers.PATTERN)


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.without_repeats(table(spark, sf_dir, "documents")).drop("removed", "kept")


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archived_pages(table(spark, sf_dir, "pages"))


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(table(spark, sf_dir, "documents"))


def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.secret_digest(table(spark, sf_dir, "documents"))


def op6_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.near_duplicates(table(spark, sf_dir, "documents"))


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.language_ids(table(spark, sf_dir, "documents"))


def op8_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.main_text(table(spark, sf_dir, "pages"))


def op9_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.edited_fingerprints(table(spark, sf_dir, "documents"))


def op10_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken", F.col("source"))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.rebuilt_trie(table(spark, sf_dir, "conversations"))


def op12_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = fm_index.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_byte_bpe, op2_suffix_dedup, op3_warc, op4_exact_dedup, op5_secret_scan, op6_ngram_join, op7_language_id, op8_html_extract,
                            op9_merkle, op10_mix, op11_prefix_trie, op12_decontaminate, op13_collocations)}
ORACLE_SQL: dict[str, str] = {"op3_warc": warc.ORACLE_SQL, "op4_exact_dedup": exact_dedup.ORACLE_SQL,
                              "op11_prefix_trie": prefix_trie.ORACLE_SQL, "op12_decontaminate": fm_index.ORACLE_SQL,
                              "op13_collocations": collocations.ORACLE_SQL}
