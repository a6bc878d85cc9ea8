"""The registered queries of this subpackage, with production parameters."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rankfold.llm import (bpe, licences, minmax, mixing, negatives, pii, quality, rans, recompress,
                          shards, spaced, suffix, whitening)
from rankfold.llm.text import documents
from rankfold.session import ensure_checkpoint_dir


def op1_minmax_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Component of near-duplicate documents and the one kept of each."""
    return minmax.classes(documents(spark, sf_dir))


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes of each document left when 50-byte strings of earlier ones go."""
    return suffix.remove_repeats(documents(spark, sf_dir)).drop("kept", "spans")


def op3_pareto_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words each document gives to the weighted mix of all sources."""
    return mixing.allocate(documents(spark, sf_dir)).select(
        "doc_id", "size", "source_size", F.round("target", 6).alias("target"), "taken", "source",
        "copies")


def op4_bootstrapped_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data of each document, with identifiers found by learnt contexts."""
    return pii.detect(documents(spark, sf_dir))


def op5_recompression(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of each document left when 20-word windows found earlier go."""
    return recompress.remove_repeats(documents(spark, sf_dir)).drop("kept", "spans")


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base counts and the verdict of the certified quality rules."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality.judge(documents(spark, sf_dir), labels)


def op7_rans_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents of the rANS token files, read back from them."""
    path = f"{ensure_checkpoint_dir(spark)}/op7-{uuid.uuid4().hex}"
    return rans.encode_corpus(documents(spark, sf_dir), path)


def op8_licence_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best licence notice in each document, by the Dice coefficient of bigrams."""
    return licences.classify(documents(spark, sf_dir))


def op9_spaced_seeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that overlap a benchmark item, with the item."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return spaced.contaminated(documents(spark, sf_dir), benchmark)


def op10_feistel_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shard and slot of each document under law ``rows``."""
    return shards.assign(documents(spark, sf_dir))


def op11_shared_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of each anchor and positive of the embeddings."""
    return negatives.mine(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op12_merge_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Byte-level BPE ids of each document, and what they decode to."""
    return bpe.digests(documents(spark, sf_dir))


def op13_spectrum_slices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The embeddings whitened by their leading components."""
    return whitening.whiten(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


QUERIES = {
    "op1_minmax_dedup": op1_minmax_dedup,
    "op2_suffix_dedup": op2_suffix_dedup,
    "op3_pareto_mix": op3_pareto_mix,
    "op4_bootstrapped_pii": op4_bootstrapped_pii,
    "op5_recompression": op5_recompression,
    "op6_quality_rules": op6_quality_rules,
    "op7_rans_tokens": op7_rans_tokens,
    "op8_licence_scan": op8_licence_scan,
    "op9_spaced_seeds": op9_spaced_seeds,
    "op10_feistel_shards": op10_feistel_shards,
    "op11_shared_lists": op11_shared_lists,
    "op12_merge_replay": op12_merge_replay,
    "op13_spectrum_slices": op13_spectrum_slices,
}
