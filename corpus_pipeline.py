"""A training-data pipeline over `documents`: each stage reads what the one before has written."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from tablebridge.llm import decontaminate, pii, quality, sentence_pieces, shingles
from tablebridge.llm.staging import stage, table


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality trees reject go. The trees are fitted on a bounded sample of labelled documents."""
    return quality.accepted(docs, quality.fit(docs, table(spark, sf_dir, "labels")))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates the document with the smallest doc_id stays.

    Near-duplicates share 0.8 or more of their five-word shingles (Jaccard); groups are chains of them. SimHash links (op1's operator)
    propose pairs, min-hash bands those that are further apart than its 2 bits; each is verified. Equal rows become one. Rows without a doc_id stay: no group can name them.
    """
    keep = shingles.least_ids(docs.where("doc_id is not null"))
    named = docs.join(keep, "doc_id", "left_semi").dropDuplicates(docs.columns).select(docs.columns)
    return named.unionByName(docs.where("doc_id is null"))


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark passage, edits included, go."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def redacted(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data becomes the name of its kind in brackets; n_chars follows the new text."""
    return pii.redact(docs, pii.fit(docs)).withColumn("n_chars", F.length("text").cast("long"))


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_pieces, ids, decoded, exact of every document that is left."""
    return sentence_pieces.encode(docs, public_tokenizers.path("piece_bpe_32k.model"))


STAGES = [("quality", good_quality), ("near_dedup", near_dedup), ("decontamination", decontaminated), ("pii", redacted), ("sentence_pieces", encoded)]
#: No SQL says this; tests/llm/test_pipeline.py compares each stage with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`; each result is written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), name)
    return docs
