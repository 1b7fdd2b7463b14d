"""A corpus pipeline: quality rules, exact dedup, near-duplicate dedup, mixing, encoding.

Each stage takes (spark, docs, sf_dir) and gives a DataFrame; all but the last give the columns of documents, whatever their names.

Nulls: a null text has no words, so the quality rules reject it; null languages and sources are groups of their own; rows with a null
doc_id are judged by their text and are near duplicates of none. Empty texts go with the nulls, very long ones are judged whole. Rows
that repeat: exact dedup keeps one, of ties in doc_id one. Rows that share a doc_id with different texts stay or go together as near
duplicates. Empty tables give empty ones; without labels, or with labels of one domain, mixing keeps all.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lineloom.llm import op4_mixing, op5_sentencepiece, op6_dart_minhash, op9_quality, op10_exact_dedup
from lineloom.llm.common import cut, table
from lineloom.llm.op1_token_counts import model_bytes


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that the base rule or the adaptive thresholds reject go."""
    return op9_quality.kept(docs)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the largest doc_id stays."""
    return op10_exact_dedup.kept(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near duplicates the row with the least doc_id stays."""
    return op6_dart_minhash.kept(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each row stays as often as its rate says."""
    return op4_mixing.mixed(docs, table(spark, sf_dir, "labels"))


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids and their digests; what decoding gives back."""
    return op5_sentencepiece.digests(docs, model_bytes())


STAGES = [("quality_rules", quality_rules), ("exact_dedup", exact_dedup), ("near_dedup", near_dedup), ("mixing", mixing), ("encoding", encoding)]

#: The quality verdict, the sketches and the mix are beyond SQL; tests compare with plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
