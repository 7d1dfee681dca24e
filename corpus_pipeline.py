"""The corpus pipeline: stages that each call one operator of :mod:`starloom.llm`.

A stage takes the documents that its predecessor kept and returns what it keeps, with the columns of documents; the
last one adds the pieces.  Null ids, texts, languages and sources are values like any others (see the operators), an
empty table passes through, and further columns stay as they are.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from starloom.llm import decontamination, near_duplicates, pieces, quality_rules, secret_scan
from starloom.llm.common import staged


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that neither the base rules nor the estimate of their language and source reject."""
    return quality_rules.keep_good(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of equal and nearly equal texts the document with the least id."""
    return near_duplicates.keep_one(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no item of the benchmark."""
    return decontamination.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets in their texts replaced by the kind in brackets."""
    return secret_scan.redact(docs)


def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents with the pieces of their texts, the text decoded from them."""
    return pieces.encode_documents(docs, public_tokenizers.path("piece_bpe_32k.model"), scores="zipf")


STAGES = [
    ("quality_rules", quality),
    ("near_dedup", near_dedup),
    ("decontamination", decontaminate),
    ("secret_scan", secrets),
    ("sentencepiece", sentencepiece),
]

#: SQL expresses neither the robust estimates nor the alignments nor the segmentation.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to the documents table, each to what the one before has written."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), "pipeline")
    return STAGES[-1][1](spark, docs, sf_dir)
