"""Corpus pipeline: toxicity, line dedup, n-gram Jaccard join, mixing to target weights, byte-level BPE.

Each stage takes (spark, docs, sf_dir) and works on all that its predecessor kept; what a stage returns is
written as Parquet and read again as the next one's docs. All stages but the last return the columns of documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidepanel.llm import jaccard_join, line_spread, mixing, prefix_bpe, weak_toxicity
from tidepanel.llm.common import Tables, read


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go."""
    return weak_toxicity.without_toxic(docs, read(spark, sf_dir, "labels"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Boilerplate lines go from all texts, whatever their share; every document stays, with n_chars brought up to date."""
    out = line_spread.remove_spread_lines(docs)
    chars = F.when(F.col("n_removed") > 0, F.length("text")).otherwise(F.col("n_chars")) if "n_chars" in docs.columns else None
    return out.select(*[chars.cast("long").alias(c) if c == "n_chars" else c for c in docs.columns])


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of similar documents one row of the smallest id stays; rows with a null id and texts without words stay.

    Rows that repeat an id are judged each by its own text, and equal rows become one.
    """
    found = jaccard_join.similar_documents(docs, with_keys=True).where("doc_id IS NOT NULL")
    first = found.where("doc_id = component_id AND component_key IS NOT NULL").groupBy("component_key").agg(F.min(F.struct("doc_id", "text_hash")).alias("row")).select("row.*")
    keep = first.unionByName(found.where("component_key IS NULL").select("doc_id", "text_hash")).distinct().select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"))
    own = docs.where("doc_id IS NOT NULL")
    kept = own.join(keep, (own["doc_id"] == F.col("_id")) & (F.xxhash64(own["text"]) == F.col("_hash")), "left_semi")
    return kept.dropDuplicates(["doc_id", "text"]).unionByName(docs.where("doc_id IS NULL")).select(*docs.columns)


def target_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as many times as its rate says: 0, once or more; the targets are the operator's own."""
    whole = docs.select("doc_id", "text", F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    out = mixing.mix(whole, read(spark, sf_dir, "labels"), keep=["row"])
    out = out.where("copies > 0").select(F.explode(F.array_repeat("row", F.col("copies").cast("int"))).alias("row"))
    return out.select(*[F.col("row")[c].alias(c) for c in docs.columns])


def byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, with the digests of ids and of the decoded text."""
    return prefix_bpe.round_trip(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


STAGES = [("toxicity", toxicity), ("line_dedup", line_dedup), ("near_duplicates", near_duplicates), ("target_mix", target_mix), ("byte_bpe", byte_bpe)]

#: A trained classifier, components and BPE have no SQL form; the tests hold the stages against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables, docs = Tables(spark, "pipeline"), read(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = tables.write(docs)
    return docs
