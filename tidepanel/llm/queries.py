"""The numbered queries: each applies its operator to its whole table with production parameters."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidepanel.llm import divergence, jaccard_join, line_spread, metric_join, mixing, oracle, packing, piece_count, prefix_bpe, resampling, suffix_dedup, surrogates, weak_toxicity, whitening
from tidepanel.llm.common import read

#: Stands for the secret that a deployment passes to the operator.
SURROGATE_KEY = "surrogates-v1"


def op1_metric_range_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metric_join.near_duplicates(read(spark, sf_dir, "embeddings"))


def op2_divergence_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.quality(read(spark, sf_dir, "documents"))


def op3_line_spread(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_spread.remove_spread_lines(read(spark, sf_dir, "documents")).select("doc_id", "source", "n_removed", "text")


def op4_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return surrogates.pseudonymise(read(spark, sf_dir, "documents"), SURROGATE_KEY)


def op5_soft_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"), with_residual=True, keep=["doc_id"])


def op6_weak_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return weak_toxicity.toxicity_scores(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op7_jaccard_rtree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.similar_documents(read(spark, sf_dir, "documents"))


def op8_piece_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piece_count.token_counts(read(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op9_deep_shallow(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = suffix_dedup.repeated_bytes(read(spark, sf_dir, "documents")).drop("spans")
    return out.withColumn("shortened", F.col("n_removed") > 0)


def op10_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_bpe.round_trip(read(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"),
                                 public_tokenizers.PATTERN, with_ids=False)


def op11_block_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(read(spark, sf_dir, "embeddings"))[0]


def op12_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resampling.resample(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op13_genetic_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), with_ids=False)


QUERIES = {f.__name__: f for f in (op1_metric_range_join, op2_divergence_quality, op3_line_spread, op4_surrogates, op5_soft_mixing,
                                   op6_weak_toxicity, op7_jaccard_rtree, op8_piece_counts, op9_deep_shallow, op10_byte_bpe, op11_block_whitening, op12_importance_resampling, op13_genetic_packing)}
ORACLE_SQL = {op1_metric_range_join.__name__: oracle.OP1, op3_line_spread.__name__: oracle.OP3, op7_jaccard_rtree.__name__: oracle.OP7}
