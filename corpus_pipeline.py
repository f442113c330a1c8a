"""The corpus pipeline: stages over documents, each written as Parquet and read again as the next one's documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sieveline.llm import near_dedup, packing, quality, suffix_dedup
from sieveline.llm.common import Scratch, table
from sieveline.llm.queries import GPT_50K


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules and the robust outlier rule let pass."""
    return quality.filtered(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group whose sets of 5-word shingles are similar by 0.8 or more."""
    return near_dedup.filtered(docs, n_words=5, threshold=0.8)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages of 50 words and more that an earlier document holds."""
    return suffix_dedup.deduplicated(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of at most 1024 ids from all documents that are left."""
    return packing.pack_pieces(docs, *GPT_50K)


STAGES = [("quality", quality_rules), ("near_duplicates", near_duplicates), ("repeated_passages", repeated_passages), ("packing", pack)]

#: Outlier estimates, similarity and packing can't be told in SQL; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order, from the table ``documents``."""
    docs, scratch = table(spark, sf_dir, "documents"), Scratch(spark, "pipeline")
    for name, stage in STAGES[:-1]:
        docs = scratch.table(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
