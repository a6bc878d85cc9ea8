"""Corpus pipeline: raw documents to encoded training tokens.

Each stage is ``(name, function)``; the function takes ``(spark, docs,
sf_dir)`` and returns a DataFrame, which is written as Parquet and read again
as the next stage's ``docs``.  All stages but the last return the columns of
``docs``; the last returns, for each document row it got, the place of its
tokens in the token files, their number and their CRC-32.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from rankfold.llm import minmax, mixing, quality, rans, spaced
from rankfold.session import ensure_checkpoint_dir

# Production parameter: near copies are linked from a Jaccard similarity of 0.80 on.
NEAR_PERCENT = 80


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the certified cutoffs."""
    return quality.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the one with the smallest id, of each group of near copies."""
    return minmax.keep_one(docs, NEAR_PERCENT)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that overlap no benchmark item."""
    return spaced.keep_clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents mixed to the source weights, each as often as it is taken."""
    return mixing.mix(docs)


def token_files(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as rANS token files, read back."""
    path = f"{ensure_checkpoint_dir(spark)}/corpus-{uuid.uuid4().hex}"
    return rans.encode_corpus(docs, path)


STAGES = [
    ("quality_rules", quality_rules),
    ("near_dedup", near_dedup),
    ("decontaminate", decontaminate),
    ("source_mix", source_mix),
    ("token_files", token_files),
]

# Word-level hashing, union of links and the tokenizer are beyond SQL; tests/llm holds
# every stage against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents, each written as Parquet and read again."""
    out = f"{ensure_checkpoint_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (name, stage) in enumerate(STAGES):
        path = f"{out}/{k}_{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
