"""Data-contract validation of one hour of raw data."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bidloom.operators import quality
from bidloom.plans.enrichment import Inputs


def dataset_counts(raw: Inputs) -> DataFrame:
    """`raw.eligible` and `raw.features` are the raw tables here."""
    both = raw.impressions_same.select("bid_request_id").unionByName(raw.impressions_late.select("bid_request_id"))
    return quality.row_counts({
        "bids": raw.bids,
        "impressions_feedback_same_hour": raw.impressions_same,
        "impressions_feedback_late_hour": raw.impressions_late,
        "impressions_feedback_total": both,
        "contextual": raw.contextual,
        "matched_user_data": raw.eligible,
        "advertiser": raw.advertiser,
        "koa_settings": raw.settings,
        "feature_log": raw.features,
        "sib": raw.sib,
    })


def overlap_checks(raw: Inputs) -> list:
    """The tables that share keys with the bids. The feature check exists on the user alone and on the job's full key."""
    feedback = raw.impressions_same.select("bid_request_id").unionByName(raw.impressions_late.select("bid_request_id"))
    checks = [
        ("bids_to_impressions_bid_request_id", feedback, ["bid_request_id"]),
        ("bids_to_matched_user_data_bid_request_id", raw.eligible, ["bid_request_id"]),
        ("bids_to_advertiser_advertiser_id", raw.advertiser, ["advertiser_id"]),
        ("bids_to_contextual_contextual_id", raw.contextual, ["contextual_id"]),
        ("bids_to_feature_log_user_id_hash", raw.features, ["user_id_hash"]),
        ("bids_to_sib_user_id_hash", raw.sib, ["user_id_hash"]),
        ("bids_to_koa_settings_advertiser_campaign", raw.settings, ["advertiser_id", "campaign_id"]),
        ("bids_to_feature_log_user_context", raw.features, ["user_id_hash", "contextual_id"]),
    ]
    return [(name, df, [(k, k) for k in keys]) for name, df, keys in checks]


def overlaps(raw: Inputs) -> DataFrame:
    """Keys of the bids found in each table."""
    return quality.key_overlaps(raw.bids, overlap_checks(raw))


def overlap_estimates(raw: Inputs) -> DataFrame:
    """The same from sketches, with their errors."""
    return quality.overlap_estimates(raw.bids, overlap_checks(raw))


def skew_indicators(bids: DataFrame, n: int = 5) -> DataFrame:
    """Rows per frequency bracket, and the n busiest advertisers and contexts, from one scan of the bids."""
    shown = {"frequency_bracket": "frequency_bracket", "top_advertiser": "advertiser_id",
             "top_contextual": "contextual_id"}
    keys = [F.struct(F.lit(name).alias("indicator"), F.col(c).cast("string").alias("key")) for name, c in shown.items()]
    counted = (
        bids.select(F.explode(F.array(*keys)).alias("k")).groupBy("k.indicator", "k.key")
        .agg(F.count(F.lit(1)).alias("rows"))
    )
    return quality.top_per_group(counted, "indicator", "rows", "key", n)
