"""The registered queries of the operators, and their SQL where SQL can say the same."""

from __future__ import annotations

from pyspark.sql import functions as F

from bidloom.llm import (
    conversations, decontamination, jaccard, language, licenses, mixing, quality, secrets, sharding, simhash, spelling,
    toxicity, warc,
)
from bidloom.llm import oracles as sql
from bidloom.registry.base import Query, table

SHARDS = 40


def op1_license_scan(spark, sf_dir):
    return licenses.license_table(table(spark, sf_dir, "documents"))


def op2_toxicity(spark, sf_dir):
    return toxicity.toxicity_table(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_benchmark_leaks(spark, sf_dir):
    return decontamination.leak_table(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op4_rendezvous_shards(spark, sf_dir):
    rows = sharding.record_table(table(spark, sf_dir, "documents"), [1.0] * SHARDS, 1.0)
    return rows.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")


def op5_warc_round_trip(spark, sf_dir):
    return warc.round_trip(table(spark, sf_dir, "pages"))


def op6_mix_sources(spark, sf_dir):
    return mixing.mix_table(table(spark, sf_dir, "documents").select("doc_id", "source", "text"))


def op7_quality_rules(spark, sf_dir):
    return quality.quality_table(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_secret_scan(spark, sf_dir):
    return secrets.secret_table(table(spark, sf_dir, "documents"))


def op9_simhash_groups(spark, sf_dir):
    return simhash.component_table(table(spark, sf_dir, "documents"))


def op10_language(spark, sf_dir):
    return language.language_table(table(spark, sf_dir, "documents"))


def op11_spelling_variants(spark, sf_dir):
    return spelling.variant_table(table(spark, sf_dir, "documents"))


def op12_conversation_repair(spark, sf_dir):
    return conversations.repair_table(table(spark, sf_dir, "conversations"))


def op13_ngram_jaccard(spark, sf_dir):
    return jaccard.component_table(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Query] = {
    "op1_license_scan": op1_license_scan,
    "op2_toxicity": op2_toxicity,
    "op3_benchmark_leaks": op3_benchmark_leaks,
    "op4_rendezvous_shards": op4_rendezvous_shards,
    "op5_warc_round_trip": op5_warc_round_trip,
    "op6_mix_sources": op6_mix_sources,
    "op7_quality_rules": op7_quality_rules,
    "op8_secret_scan": op8_secret_scan,
    "op9_simhash_groups": op9_simhash_groups,
    "op10_language": op10_language,
    "op11_spelling_variants": op11_spelling_variants,
    "op12_conversation_repair": op12_conversation_repair,
    "op13_ngram_jaccard": op13_ngram_jaccard,
}
ORACLES: dict[str, str] = {
    "op1_license_scan": sql.LICENSE_SCAN,
    "op4_rendezvous_shards": sql.RENDEZVOUS_SHARDS,
    "op5_warc_round_trip": sql.WARC_ROUND_TRIP,
    "op6_mix_sources": sql.MIX_SOURCES,
    "op8_secret_scan": sql.SECRET_SCAN,
    "op11_spelling_variants": sql.SPELLING_VARIANTS,
    "op12_conversation_repair": sql.REPAIR_CONVERSATIONS,
}
