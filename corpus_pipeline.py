"""Corpus pipeline: each stage reads what its predecessor kept, written as Parquet in between.

1. language_id: documents without any letter, or without text, go; all others stay.
2. near_dedup: of each group of near-duplicates the document with the smallest id stays.
3. decontamination: documents with benchmark passages go.
4. secrets: every secret in a text is replaced by a mark; all documents stay.
5. bpe: token counts and digests of the ids and of the decoded text, a row for each document.

Stages 1 to 4 return the columns of ``documents``. An empty table passes through all stages.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from gustmill.llm import bpe, decontamination, language_id, minhash, secrets
from gustmill.llm.tables import importable_in_workers, scratch_folder, table


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    importable_in_workers(spark)
    return language_id.accepted(docs)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    importable_in_workers(spark)
    return minhash.keep_one(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontamination.clean_documents(docs, table(spark, sf_dir, "benchmark"))


def secrets_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secrets.redacted(docs)


def bpe_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    importable_in_workers(spark)
    return bpe.encoding_digests(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("language_id", language_stage),
    ("near_dedup", near_dedup_stage),
    ("decontamination", decontamination_stage),
    ("secrets", secrets_stage),
    ("bpe", bpe_stage),
]

#: Near-duplicates by signatures and the language model have no SQL; tests use brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    folder = f"{scratch_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
