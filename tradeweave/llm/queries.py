"""One query per operator, with production parameters, over its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradeweave.llm import (
    bpe,
    filter_audit,
    fingerprint,
    jaccard,
    packing,
    quality,
    recompression,
    simhash,
    suffix_dedup,
    token_counts,
    toxicity,
    warc,
    whitening,
)
from tradeweave.llm.common import table
from tradeweave.llm.oracle import ORACLE


def op1_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    rows = bpe.decode(bpe.encode(docs))
    return rows.select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256")
    )


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = packing.pack(packing.pieces(table(spark, sf_dir, "documents")))
    return parts.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.suffix_dedup(table(spark, sf_dir, "documents")).drop("kept")


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.section_tokens(table(spark, sf_dir, "documents"))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.jaccard_components(table(spark, sf_dir, "documents"))


def op7_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.fingerprints(table(spark, sf_dir, "documents"))


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return recompression.substring_dedup(table(spark, sf_dir, "documents")).drop("kept")


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_rules(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_warc_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_round_trip(table(spark, sf_dir, "pages"))


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.filter_audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op12_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_components(table(spark, sf_dir, "documents"))


def op13_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = whitening.whitening(table(spark, sf_dir, "embeddings"))
    return rows.withColumn("deviation", F.col("deviation").try_cast("long"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_bpe_round_trip,
        op2_packing,
        op3_suffix_dedup,
        op4_token_counts,
        op5_toxicity,
        op6_jaccard_join,
        op7_fingerprints,
        op8_substring_dedup,
        op9_quality_rules,
        op10_warc_archive,
        op11_filter_audit,
        op12_simhash_dedup,
        op13_embedding_whitening,
    )
}

__all__ = ["ORACLE", "QUERIES"]
