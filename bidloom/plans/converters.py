"""The two converters that feed the enrichment job."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bidloom import fixed_values as fv
from bidloom.functions import scalars as s
from bidloom.operators.dedup import keep_extreme
from bidloom.operators.quality import audited, distinct_rows, long_metrics
from bidloom.sources.files import HOUR_PARTS
from bidloom.sources.sinks import write_by_key

# Output contracts.
FEATURE_COLUMNS = (
    "feature_event_id", "user_id", "normalized_user_id", "source_user_id_hash", "user_id_hash", "user_uuid",
    "contextual_id", "contextual_join_key", "feature_name", "feature_value", "feature_value_bucket",
    "event_timestamp", "rounded_event_time", *HOUR_PARTS,
)
ELIGIBLE_COLUMNS = (
    "bid_request_id", "bid_request_hash", "user_id", "normalized_user_id", "source_user_id_hash", "user_id_hash",
    "user_uuid", "segment_id", "is_eligible", "eligible_user_flag", "eligibility_score", "eligibility_band",
    "frequency_bracket", *HOUR_PARTS,
)


def identity_columns(with_source: bool = True) -> dict[str, Column]:
    """Normalised user id, the hash it came with, and the hash recomputed from the normalised form."""
    normalized = s.normalize_id("user_id")
    return {
        "normalized_user_id": normalized,
        **({"source_user_id_hash": F.col("user_id_hash")} if with_source else {}),
        "user_id_hash": s.sha256_hex(normalized),
        "user_uuid": s.stable_uuid(normalized),
    }


# Raw columns that the converted ones are made of, where these have another name.
SOURCES = {
    "normalized_user_id": "user_id", "source_user_id_hash": "user_id_hash", "user_id_hash": "user_id",
    "user_uuid": "user_id", "contextual_join_key": "contextual_id", "rounded_event_time": "event_timestamp",
    "feature_value_bucket": "feature_value", "bid_request_hash": "bid_request_id", "frequency_bracket": "user_id",
    "eligibility_band": "eligibility_score", "eligible_user_flag": "is_eligible",
}


def _needed(columns: Sequence[str], always: Sequence[str]) -> set[str]:
    return {SOURCES.get(c, c) for c in columns} | set(always)


def convert_features(raw: DataFrame, columns: Sequence[str] = FEATURE_COLUMNS) -> DataFrame:
    """One row per feature event; of several, the latest.

    Rows are reduced before the derived columns are added, so the shuffle carries raw columns only, and of these what
    `columns` are made of.
    """
    # The raw columns that the derivations below name are kept until the last selection.
    always = ["feature_event_id", "user_id", "contextual_id", "event_timestamp", "feature_value"]
    unique = keep_extreme(raw, ["feature_event_id"], ["event_timestamp"], needed=_needed(columns, always))
    derived = {
        **identity_columns("user_id_hash" in unique.columns),
        "contextual_join_key": s.sha256_hex("contextual_id"),
        "rounded_event_time": s.floor_minutes("event_timestamp", fv.TIME_BUCKET_MINUTES),
        "feature_value_bucket": s.unit_score_band("feature_value"),
    }
    return unique.withColumns(derived).select(*columns)


def convert_eligible(raw: DataFrame, columns: Sequence[str] = ELIGIBLE_COLUMNS) -> DataFrame:
    """One row per bid request and normalised user; of several, the best score. `columns` as for the features."""
    normalized = raw.withColumn("_user", s.normalize_id("user_id"))
    always = ["bid_request_id", "_user", "user_id", "is_eligible", "eligibility_score"]
    unique = keep_extreme(normalized, ["bid_request_id", "_user"], ["eligibility_score"],
                          needed=_needed(columns, always))
    derived = {
        **identity_columns("user_id_hash" in unique.columns),
        "bid_request_hash": s.sha256_hex("bid_request_id"),
        "frequency_bracket": s.frequency_of_user(s.normalize_id("user_id")),
        "eligibility_band": s.percent_score_band("eligibility_score"),
        "eligible_user_flag": s.flag("is_eligible"),
    }
    return unique.withColumns(derived).select(*columns)


def feature_metrics(raw: DataFrame, converted: DataFrame) -> DataFrame:
    counts = raw.agg(F.count(F.lit(1)).alias("raw_feature_log_count"))
    out = converted.agg(
        F.count(F.lit(1)).alias("converted_feature_log_count"),
        distinct_rows("user_id_hash").alias("distinct_user_hash_count"),
        distinct_rows("contextual_id").alias("distinct_contextual_count"),
    )
    section = "feature_log_converter"
    return long_metrics(counts, section).unionByName(long_metrics(out, section))


def eligible_metrics(raw: DataFrame, converted: DataFrame) -> DataFrame:
    counts = raw.agg(F.count(F.lit(1)).alias("raw_matched_user_data_count"))
    out = converted.agg(
        F.count(F.lit(1)).alias("converted_eligible_user_data_count"),
        F.count_if("is_eligible").alias("eligible_user_count"),
        F.count_if(F.col("frequency_bracket") == fv.HIGH).alias("high_frequency_count"),
        F.count_if(F.col("frequency_bracket") == fv.LOW).alias("low_frequency_count"),
    )
    section = "eligible_user_data_converter"
    return long_metrics(counts, section).unionByName(long_metrics(out, section))


def run_features(raw: DataFrame, target: str, mode: str = "overwrite") -> DataFrame:
    """The feature converter as a job: stage, audit, publish, then report on what was published."""
    staged = audited(convert_features(raw), "feature_log", ["feature_event_id"])
    write_by_key(staged, target, ["user_id_hash", "contextual_id"], mode)
    return feature_metrics(raw, raw.sparkSession.read.parquet(target))


def run_eligible(raw: DataFrame, target: str, mode: str = "overwrite") -> DataFrame:
    """The eligible-user converter as a job, likewise."""
    staged = audited(convert_eligible(raw), "eligible_user_data", ["bid_request_id", "normalized_user_id"])
    write_by_key(staged, target, ["user_id_hash", "frequency_bracket"], mode)
    return eligible_metrics(raw, raw.sparkSession.read.parquet(target))


def before_after(
    raw: DataFrame, converted: DataFrame, key: str, compared: list[str], ids: list | None = None
) -> DataFrame:
    """Raw and converted records side by side, for the given ids or for all."""
    old = raw.select(key, *[F.col(c).alias(f"raw_{c}") for c in compared])
    if ids is not None:
        old, converted = old.filter(F.col(key).isin(ids)), converted.filter(F.col(key).isin(ids))
    return old.join(converted, key)
