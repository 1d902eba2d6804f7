"""Preparing a training corpus in five stages, each on all that the one before it kept.

1. quality rules: documents that the line labelling rejects go;
2. near copies: of each group that pairs with Jaccard similarity of five-word shingles of 0.8 at least form, the smallest id stays;
3. decontamination: documents of which a benchmark passage makes up a twentieth of the words go;
4. personal data: each span is replaced by its kind in brackets, n_chars follows the text;
5. packing: what is left is packed into sequences of the permitted lengths.

All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart.llm import decontaminate, near_texts, packing, pii, quality
from tripmart.llm.common import read, settle

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep_content(docs, read(spark, sf_dir, "labels")).select(*COLUMNS)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_texts.one_of_each(docs).select(*COLUMNS)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.clean(docs, read(spark, sf_dir, "benchmark")).select(*COLUMNS)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    masked = pii.redact(docs)
    return masked.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs)


STAGES = [
    ("quality", quality_rules),
    ("near_copies", near_copies),
    ("decontamination", decontamination),
    ("personal_data", personal_data),
    ("packing", best_fit_packing),
]
# The trained field, the minhashes and the packing have no SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = settle(stage(spark, docs, sf_dir), "stage")
    return STAGES[-1][1](spark, docs, sf_dir)
