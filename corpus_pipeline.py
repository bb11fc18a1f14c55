"""From raw documents to packed training sequences: quality rules, line and near-duplicate removal, benchmark
decontamination, packing.  Each stage works on what the stage before it kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from trilayer.llm.common import documents, stored
from trilayer.llm.decontaminate import clean_documents
from trilayer.llm.line_dedup import dedup_lines
from trilayer.llm.packing import pack_documents
from trilayer.llm.quality import fit_on_labels, good_documents
from trilayer.llm.queries import TOKENIZERS, benchmark, labels
from trilayer.llm.simhash import one_of_each


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return good_documents(docs, fit_on_labels(docs, labels(spark, sf_dir)))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return dedup_lines(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return clean_documents(docs, benchmark(spark, sf_dir))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pack_documents(docs, f"{TOKENIZERS}/word_bpe_49k.json")


STAGES = [
    ("quality rules", quality),
    ("line dedup", lines),
    ("near-duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("packing", packing),
]

#: The field of the quality rules, fingerprints and tokens are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
