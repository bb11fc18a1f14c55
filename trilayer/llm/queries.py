"""The registered queries: each operator over its whole table, with production parameters."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

from trilayer.llm.common import documents
from trilayer.llm.decontaminate import find_contamination
from trilayer.llm.edit_counts import edited_token_counts, planned_edits
from trilayer.llm.katz import score_digest
from trilayer.llm.licenses import license_scan
from trilayer.llm.line_dedup import line_digest
from trilayer.llm.packing import packing_digest
from trilayer.llm.pii import personal_data_digest
from trilayer.llm.prefix_trie import conversation_trie
from trilayer.llm.quality import fit_on_labels, quality_digest
from trilayer.llm.sharding import shard_digest
from trilayer.llm.simhash import near_duplicate_digest
from trilayer.llm.suffix_dedup import without_repeats
from trilayer.llm.whitening import whitening_digest

#: Folder of the vocabulary files.
TOKENIZERS = os.environ.get("TOKENIZERS_DIR", "/opt/tokenizers")


def benchmark(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/benchmark.parquet")


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return quality_digest(docs, fit_on_labels(docs, labels(spark, sf_dir)))


def op2_jump_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_digest(documents(spark, sf_dir))


def op3_histogram_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing_digest(documents(spark, sf_dir), f"{TOKENIZERS}/word_bpe_49k.json")


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_digest(documents(spark, sf_dir))


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicate_digest(documents(spark, sf_dir))


def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan(documents(spark, sf_dir)).drop("spans")


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_contamination(documents(spark, sf_dir), benchmark(spark, sf_dir)).drop("spans")


def op8_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal_data_digest(documents(spark, sf_dir))


def op9_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return without_repeats(documents(spark, sf_dir)).drop("kept")


def op10_edited_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edited_token_counts(planned_edits(documents(spark, sf_dir)), f"{TOKENIZERS}/byte_bpe_50k.json")


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_trie(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening_digest(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op13_katz_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_digest(documents(spark, sf_dir))


QUERIES = {
    f.__name__: f
    for f in (
        op1_quality_rules, op2_jump_shards, op3_histogram_packing, op4_line_dedup, op5_simhash, op6_license_scan, op7_decontamination,
        op8_personal_data, op9_repeated_passages, op10_edited_counts, op11_prefix_trie, op12_whitening, op13_katz_scores,
    )
}
