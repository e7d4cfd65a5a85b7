"""A training corpus from raw documents: quality, near-duplicates, benchmark leaks, mixture, shards.

Every stage works on all that its predecessor kept and has its input as a written table. All but the last return the
columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from bidloom.llm import decontamination, mixing, quality, sharding, simhash
from bidloom.registry.base import table
from bidloom.session import materialize

SHARDS = 40


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules reject go: null and empty texts, too few or too repetitive words, unlikely n-grams."""
    return quality.kept_documents(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group stays, that of the smallest doc_id."""
    return simhash.survivors(docs)


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain a benchmark item, as it is or with other values, go."""
    return decontamination.clean_documents(docs, table(spark, sf_dir, "benchmark"))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mixture draws them: not at all, once or more."""
    return mixing.mixed(docs)


def shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Adds each document's shard, and that with one shard more; columns of these names are replaced."""
    return sharding.shards(docs, "doc_id", [1.0] * SHARDS, 1.0)


STAGES = [
    ("quality_rules", quality_rules),
    ("simhash_near_duplicates", near_duplicates),
    ("benchmark_decontamination", benchmark_leaks),
    ("source_mixture", mixture),
    ("rendezvous_shards", shards),
]
# The near-duplicate stage follows links of any length over fingerprints that SQL engines do not agree on.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`, each written as Parquet in the shared work folder and read again by the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return docs
