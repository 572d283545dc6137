"""A corpus from raw documents to packed sequences.

Stages, in order: quality rules (rejected documents go), toxicity (documents
scored toxic go), n-gram Jaccard join (one document of each group stays),
suffix-array dedup (repeated byte strings are cut out of the texts), packing
(sequences of tokens). Each works on all that the one before it kept; all but
the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tradeweave.llm import jaccard, packing, quality, suffix_dedup, toxicity
from tradeweave.llm.common import stored, table

#: Bytes of a repeated passage: some 50 words of short text have little more.
PASSAGE_BYTES = 200


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.keep_clean(docs, table(spark, sf_dir, "labels"))


def jaccard_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard.keep_one(docs)


def suffix_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return suffix_dedup.without_repeats(docs, PASSAGE_BYTES)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    parts = packing.pack(packing.pieces(docs))
    return parts.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


STAGES = [
    ("quality_rules", quality_stage),
    ("toxicity", toxicity_stage),
    ("jaccard_join", jaccard_stage),
    ("suffix_dedup", suffix_stage),
    ("packing", packing_stage),
]

#: The learned stages and the tokenizer are beyond SQL; tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
