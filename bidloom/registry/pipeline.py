"""Registered joins, aggregations and composite jobs."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bidloom import fixed_values as fv
from bidloom.functions import scalars as s
from bidloom.functions.fixed_point import money_sum
from bidloom.operators import dedup, fanout, intervals, nullable, quality, skew
from bidloom.plans import converters, enrichment, remedies, revenue
from bidloom.registry import roles
from bidloom.registry.base import ORACLES, register, table
from bidloom.registry.roles import (
    ADVERTISER, BIDS, CONTEXTUAL, ELIGIBLE, FEATURES, IMPRESSIONS, JOINED, METRICS, RAW_BIDS, RAW_IMPRESSIONS,
    SETTINGS, SIB, sql_money,
)
from bidloom.session import materialize, work_folder

GROUPS = ("advertiser_id, campaign_id, contextual_id, final_frequency_bracket AS frequency_bracket, content_category, "
          "koa_group")
GROUP_BY = "advertiser_id, campaign_id, contextual_id, final_frequency_bracket, content_category, koa_group"


# --- revenue ----------------------------------------------------------------

@register("daily_product_revenue", f"""
SELECT CAST(o_orderdate AS DATE) AS order_date, o_orderstatus AS order_status, l_partkey AS product_id,
       {sql_money('l_extendedprice * (1 - l_discount)')} AS revenue
FROM orders JOIN lineitem ON l_orderkey = o_orderkey GROUP BY ALL ORDER BY order_date, revenue DESC
""")
def daily_product_revenue(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("order_id"), F.col("o_orderdate").cast("date").alias("order_date"),
        F.col("o_orderstatus").alias("order_status"),
    )
    items = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("order_id"), F.col("l_partkey").alias("product_id"),
        (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("subtotal"),
    )
    return revenue.daily_product_revenue(orders, items)


# --- converters and preparation ---------------------------------------------

@register("feature_convert", f"WITH {FEATURES} SELECT * FROM features")
def feature_convert(spark, sf_dir):
    out = converters.convert_features(roles.feature_log(spark, sf_dir))
    return out.withColumn("rounded_event_time", F.col("rounded_event_time").cast("timestamp_ntz"))


@register("eligible_convert", f"WITH {ELIGIBLE} SELECT * FROM eligible")
def eligible_convert(spark, sf_dir):
    return converters.convert_eligible(roles.matched_users(spark, sf_dir))


@register("prepare_bids", f"""
WITH {BIDS} SELECT * REPLACE (CAST(event_quality_score AS DOUBLE) AS event_quality_score) FROM bids
""")
def prepare_bids(spark, sf_dir):
    out = enrichment.prepare_bids(roles.bids(spark, sf_dir))
    return out.withColumn("rounded_bid_time", F.col("rounded_bid_time").cast("timestamp_ntz"))


@register("converter_metrics", f"""
WITH {FEATURES}, {ELIGIBLE}
SELECT 'feature_log_converter' AS section, unnest(['raw_feature_log_count', 'converted_feature_log_count',
         'distinct_user_hash_count', 'distinct_contextual_count']) AS name,
       unnest([(SELECT count(*) FROM raw_features), count(*), count(DISTINCT user_id_hash),
         count(DISTINCT contextual_id)]) AS value
FROM features
UNION ALL
SELECT 'eligible_user_data_converter', unnest(['raw_matched_user_data_count', 'converted_eligible_user_data_count',
         'eligible_user_count', 'high_frequency_count', 'low_frequency_count']),
       unnest([(SELECT count(*) FROM raw_matched), count(*), count(*) FILTER (is_eligible),
         count(*) FILTER (frequency_bracket = 'high'), count(*) FILTER (frequency_bracket = 'low')])
FROM eligible
""")
def converter_metrics(spark, sf_dir):
    features = converters.run_features(roles.feature_log(spark, sf_dir), work_folder(spark, "feature_log"))
    return features.unionByName(
        converters.run_eligible(roles.matched_users(spark, sf_dir), work_folder(spark, "eligible_user_data"))
    )


@register("sample_before_after", f"""
WITH {FEATURES}
SELECT feature_event_id, r.user_id AS raw_user_id, r.user_id_hash AS raw_user_id_hash, c.normalized_user_id,
       c.user_id_hash, c.feature_value_bucket
FROM raw_features r JOIN features c USING (feature_event_id)
""")
def sample_before_after(spark, sf_dir):
    raw = roles.feature_log(spark, sf_dir)
    both = converters.before_after(
        raw, converters.convert_features(raw), "feature_event_id", ["user_id", "user_id_hash"]
    )
    return both.select("feature_event_id", "raw_user_id", "raw_user_id_hash", "normalized_user_id", "user_id_hash",
                       "feature_value_bucket")


@register("named_features", """
SELECT event_type, count(*) AS rows FROM events WHERE event_type IN ('purchase', 'signup') GROUP BY event_type
""")
def named_features(spark, sf_dir):
    chosen = remedies.only_named(table(spark, sf_dir, "events"), "event_type", ["purchase", "signup"])
    return chosen.groupBy("event_type").agg(F.count(F.lit(1)).alias("rows"))


# --- dedup and late feedback ------------------------------------------------

@register("late_feedback_union", f"WITH {RAW_IMPRESSIONS} SELECT * FROM raw_impressions")
def late_feedback_union(spark, sf_dir):
    return enrichment.union_feedback(
        roles.impressions(spark, sf_dir, late=False), roles.impressions(spark, sf_dir, late=True)
    )


@register("late_feedback_counts", f"""
WITH {RAW_IMPRESSIONS}
SELECT 'late_feedback' AS section, unnest(['same_hour_rows', 'late_n_plus_1_rows']) AS name,
       unnest([count(*) FILTER (feedback_type = 'same_hour'), count(*) FILTER (feedback_type = 'late_n_plus_1')])
         AS value
FROM raw_impressions
""")
def late_feedback_counts(spark, sf_dir):
    return quality.late_feedback(
        roles.impressions(spark, sf_dir, late=False), roles.impressions(spark, sf_dir, late=True), "feedback_type"
    )


@register("dedup_latest", f"WITH {IMPRESSIONS} SELECT * FROM impressions")
def dedup_latest(spark, sf_dir):
    return enrichment.prepare_impressions(
        roles.impressions(spark, sf_dir, late=False), roles.impressions(spark, sf_dir, late=True)
    )


@register("dedup_any", "SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem")
def dedup_any(spark, sf_dir):
    keys = ["l_orderkey", "l_linenumber"]
    return dedup.keep_any(table(spark, sf_dir, "lineitem"), keys).select(*keys)


# --- single joins -----------------------------------------------------------

BID_KEYS = "b.bid_request_id, b.advertiser_id, b.campaign_id, b.contextual_id, b.bid_price"
BID_COLUMNS = ["bid_request_id", "advertiser_id", "campaign_id", "contextual_id", "bid_price"]


def _dimension(bids, dimension, keys):
    return skew.lookup(bids, dimension, keys, None, BID_COLUMNS)


@register("left_enrich", f"""
WITH {RAW_BIDS}, {IMPRESSIONS}, {CONTEXTUAL}
SELECT {BID_KEYS}, i.impression_id, i.clearing_price, c.content_category
FROM raw_bids b LEFT JOIN impressions i ON b.bid_request_id = i.bid_request_id
LEFT JOIN contextual c ON b.contextual_id = c.contextual_id
""")
def left_enrich(spark, sf_dir):
    feedback = enrichment.prepare_impressions(
        roles.impressions(spark, sf_dir, late=False), roles.impressions(spark, sf_dir, late=True)
    )
    bids = roles.bids(spark, sf_dir).select(*BID_COLUMNS)
    hot = skew.find(bids, {"bid": ["bid_request_id"], "context": ["contextual_id"]})
    rows = enrichment.join_reduced(bids, feedback, [("bid_request_id", "bid_request_id")], hot["bid"])
    contexts = roles.contextual(spark, sf_dir)
    rows = enrichment.join_reduced(rows, contexts, [("contextual_id", "contextual_id")], hot["context"])
    return rows.select(*BID_COLUMNS, "impression_id", "clearing_price", "content_category")


@register("broadcast_dim", f"""
WITH {RAW_BIDS}, {ADVERTISER}
SELECT a.vertical, a.priority_tier, count(*) AS rows, count(DISTINCT b.bid_request_id) AS bids
FROM raw_bids b LEFT JOIN advertiser a ON b.advertiser_id = a.advertiser_id GROUP BY ALL
""")
def broadcast_dim(spark, sf_dir):
    rows = _dimension(roles.bids(spark, sf_dir), roles.advertiser(spark, sf_dir), ["advertiser_id"])
    return rows.groupBy("vertical", "priority_tier").agg(
        F.count(F.lit(1)).alias("rows"), F.count_distinct("bid_request_id").alias("bids")
    )


@register("composite_key_join", f"""
WITH {RAW_BIDS}, {SETTINGS}
SELECT {BID_KEYS}, s.koa_group, s.bid_modifier, s.policy_mode FROM raw_bids b
LEFT JOIN settings s ON b.advertiser_id = s.advertiser_id AND b.campaign_id = s.campaign_id
""")
def composite_key_join(spark, sf_dir):
    bids = roles.bids(spark, sf_dir).select(*BID_COLUMNS)
    rows = _dimension(bids, roles.settings(spark, sf_dir), ["advertiser_id", "campaign_id"])
    return rows.select(*BID_COLUMNS, "koa_group", "bid_modifier", "policy_mode")


@register("left_enrich2", f"""
WITH {BIDS}, {ELIGIBLE}
SELECT {BID_KEYS}, e.segment_id, e.eligible_user_flag, e.eligibility_band, e.frequency_bracket
FROM bids b LEFT JOIN eligible e ON b.bid_request_id = e.bid_request_id AND b.user_id_hash = e.user_id_hash
""")
def left_enrich2(spark, sf_dir):
    bids = enrichment.prepare_bids(roles.bids(spark, sf_dir)).select(*BID_COLUMNS, "user_id_hash")
    eligible = converters.convert_eligible(roles.matched_users(spark, sf_dir))
    keys = ["bid_request_id", "user_id_hash"]
    rows = enrichment.join_reduced(bids, eligible, [(k, k) for k in keys], skew.find(bids, {"key": keys})["key"])
    return rows.select(*BID_COLUMNS, "segment_id", "eligible_user_flag", "eligibility_band", "frequency_bracket")


@register("dedup_then_join", f"""
WITH {BIDS}, {SIB}
SELECT {BID_KEYS}, sb.sib_group, sb.sib_score, sb.sib_source FROM bids b
LEFT JOIN (SELECT DISTINCT user_id_hash, sib_group, sib_score, sib_source FROM sib) sb
  ON b.user_id_hash = sb.user_id_hash
""")
def dedup_then_join(spark, sf_dir):
    bids = enrichment.prepare_bids(roles.bids(spark, sf_dir)).select(*BID_COLUMNS, "user_id_hash")
    sib = enrichment.prepare_sib(roles.sib(spark, sf_dir))
    hot = skew.find(bids, {"user": ["user_id_hash"]})["user"]
    rows = enrichment.join_reduced(bids, sib, [("user_id_hash", "sib_user_id_hash")], hot)
    return rows.select(*BID_COLUMNS, "sib_group", "sib_score", "sib_source")


@register("feature_fanout_join", f"""
WITH {BIDS}, {FEATURES}
SELECT b.bid_request_id, b.contextual_id, count(*) AS joined_rows, count(f.feature_event_id) AS feature_events
FROM bids b LEFT JOIN features f ON b.user_id_hash = f.user_id_hash AND b.contextual_id = f.contextual_id
GROUP BY ALL
""")
def feature_fanout_join(spark, sf_dir):
    bids = enrichment.prepare_bids(roles.bids(spark, sf_dir)).select(*BID_COLUMNS, "user_id_hash")
    features = enrichment.prepare_features(converters.convert_features(roles.feature_log(spark, sf_dir)))
    hot = skew.find(bids, {"user_context": enrichment.JOIN_KEYS["user_context"]})
    rows = enrichment.join_features(bids, features, hot["user_context"])
    return rows.groupBy("bid_request_id", "contextual_id").agg(
        F.sum("joined_rows").alias("joined_rows"), F.sum("feature_events").alias("feature_events")
    )


@register("wide_enrich", f"""
WITH {JOINED}
SELECT bid_request_id, advertiser_id, campaign_id, contextual_id, bid_price, impression_id, content_category,
       vertical, koa_group, segment_id, sib_group, count(*) AS joined_rows, count(feature_event_id) AS feature_events
FROM joined GROUP BY ALL
""")
def wide_enrich(spark, sf_dir):
    rows = enrichment.enrich(roles.job_inputs(spark, sf_dir))
    keys = [*BID_COLUMNS, "impression_id", "content_category", "vertical", "koa_group", "segment_id", "sib_group"]
    return rows.groupBy(*keys).agg(
        F.sum("joined_rows").alias("joined_rows"), F.sum("feature_events").alias("feature_events")
    )


@register("post_join_pricing", f"""
WITH {BIDS}, {SETTINGS}
SELECT b.bid_request_id, b.advertiser_id, b.campaign_id, b.contextual_id, bid_price,
       CAST(coalesce(bid_modifier, 1.0) AS DOUBLE) AS effective_bid_modifier,
       bid_price * coalesce(bid_modifier, 1.0) AS adjusted_bid_price,
       bid_price * coalesce(bid_modifier, 1.0) * event_quality_score AS quality_weighted_price
FROM bids b LEFT JOIN settings s ON b.advertiser_id = s.advertiser_id AND b.campaign_id = s.campaign_id
""")
def post_join_pricing(spark, sf_dir):
    bids = enrichment.prepare_bids(roles.bids(spark, sf_dir))
    rows = _dimension(bids, roles.settings(spark, sf_dir), ["advertiser_id", "campaign_id"])
    return rows.withColumns(s.priced("bid_price", "bid_modifier", "event_quality_score")).select(
        *BID_COLUMNS, "effective_bid_modifier", "adjusted_bid_price", "quality_weighted_price"
    )


# --- nullable lookups -------------------------------------------------------

MARKET_SQL = f"""
WITH {RAW_BIDS}, {SETTINGS},
rows AS (SELECT b.bid_request_id, b.bid_price, s.koa_group, s.policy_mode FROM raw_bids b
         LEFT JOIN settings s ON b.advertiser_id = s.advertiser_id AND b.campaign_id = s.campaign_id),
markets AS (SELECT koa_group AS market_group, policy_mode AS market_mode, count(*) AS market_rows FROM rows GROUP BY ALL)
SELECT bid_request_id, bid_price, koa_group, policy_mode, market_rows FROM rows
LEFT JOIN markets ON koa_group IS NOT DISTINCT FROM market_group AND policy_mode IS NOT DISTINCT FROM market_mode
"""
MARKET_PAIRS = [("koa_group", "market_group"), ("policy_mode", "market_mode")]


def _market(spark, sf_dir, join):
    """Bids looked up by two columns that are null together for most rows."""
    bids = roles.bids(spark, sf_dir).select(*BID_COLUMNS)
    # Read by the markets, the search for hot keys and every path of the join, so written once.
    rows = materialize(_dimension(bids, roles.settings(spark, sf_dir), ["advertiser_id", "campaign_id"]), "market_bids")
    markets = rows.groupBy(F.col("koa_group").alias("market_group"), F.col("policy_mode").alias("market_mode")).agg(
        F.count(F.lit(1)).alias("market_rows")
    )
    return join(rows, markets, MARKET_PAIRS, BID_COLUMNS).select(
        "bid_request_id", "bid_price", "koa_group", "policy_mode", "market_rows"
    )


@register("nullsafe_join", MARKET_SQL)
def nullsafe_join(spark, sf_dir):
    return _market(spark, sf_dir, nullable.null_safe_left)


@register("surrogate_key_join", MARKET_SQL)
def surrogate_key_join(spark, sf_dir):
    return _market(spark, sf_dir, nullable.surrogate_left)


@register("split_null_join", MARKET_SQL)
def split_null_join(spark, sf_dir):
    return _market(spark, sf_dir, nullable.split_null_left)


# --- fan-out ----------------------------------------------------------------

@register("join_fanout_estimate", """
WITH l AS (SELECT o_custkey AS k, count(*) AS left_rows FROM orders GROUP BY 1),
r AS (SELECT user_id AS k, count(*) AS right_rows FROM events GROUP BY 1),
j AS (SELECT left_rows, right_rows, left_rows * coalesce(right_rows, 1) AS n FROM l LEFT JOIN r USING (k))
SELECT CAST(sum(left_rows) AS BIGINT) AS left_rows, count(right_rows) AS matching_keys,
       CAST(sum(n) FILTER (right_rows IS NOT NULL) AS DOUBLE) AS inner_rows, CAST(sum(n) AS DOUBLE) AS left_join_rows,
       CAST(sum(n) FILTER (right_rows IS NOT NULL) AS DOUBLE) / count(right_rows) AS avg,
       round(quantile_cont(CAST(n AS DOUBLE), 0.5) FILTER (right_rows IS NOT NULL), 4) AS p50,
       round(quantile_cont(CAST(n AS DOUBLE), 0.75) FILTER (right_rows IS NOT NULL), 4) AS p75,
       round(quantile_cont(CAST(n AS DOUBLE), 0.95) FILTER (right_rows IS NOT NULL), 4) AS p95,
       CAST(max(n) FILTER (right_rows IS NOT NULL) AS DOUBLE) AS max
FROM j
""")
def join_fanout_estimate(spark, sf_dir):
    sizes = fanout.estimate(table(spark, sf_dir, "orders"), table(spark, sf_dir, "events"), ["o_custkey"], ["user_id"])
    shown = {c: F.round(c, 4) for c in ("p50", "p75", "p95")}
    shown |= {c: F.col(c).cast("double") for c in ("inner_rows", "left_join_rows", "max")}
    return sizes.withColumns(shown)


@register("fanout_top_keys", """
WITH l AS (SELECT o_custkey AS key_0, count(*) AS left_rows FROM orders GROUP BY 1),
r AS (SELECT user_id AS key_0, count(*) AS right_rows FROM events GROUP BY 1)
SELECT key_0, left_rows, right_rows, CAST(left_rows * right_rows AS DOUBLE) AS join_rows
FROM l JOIN r USING (key_0) ORDER BY join_rows DESC, key_0 LIMIT 20
""")
def fanout_top_keys(spark, sf_dir):
    top = fanout.largest_keys(
        table(spark, sf_dir, "orders"), table(spark, sf_dir, "events"), ["o_custkey"], ["user_id"]
    )
    return top.withColumn("join_rows", F.col("join_rows").cast("double"))


@register("key_skew_profile", """
WITH c AS (SELECT l_partkey, count(*) AS n FROM lineitem GROUP BY 1)
SELECT count(*) AS keys, CAST(sum(n) AS BIGINT) AS rows, CAST(sum(n) AS DOUBLE) / count(*) AS avg,
       round(quantile_cont(CAST(n AS DOUBLE), 0.5), 4) AS p50, round(quantile_cont(CAST(n AS DOUBLE), 0.75), 4) AS p75,
       round(quantile_cont(CAST(n AS DOUBLE), 0.95), 4) AS p95, CAST(max(n) AS BIGINT) AS max
FROM c
""")
def key_skew_profile(spark, sf_dir):
    counted = fanout.key_counts(table(spark, sf_dir, "lineitem"), ["l_partkey"], "rows_per_key")
    profile = fanout.value_profile(counted, "rows_per_key")
    shown = {c: F.round(c, 4) for c in ("p50", "p75", "p95")}
    return profile.withColumns({**shown, "rows": F.col("rows").cast("bigint"), "max": F.col("max").cast("bigint")})


USER_PAIR = [("o_custkey", "user_id")]


@register("feature_latest", """
SELECT o_orderkey, o_custkey, event_id, event_type, value FROM orders LEFT JOIN (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events)
  WHERE rn = 1) e ON o_custkey = e.user_id
""")
def feature_latest(spark, sf_dir):
    rows = remedies.join_latest(
        table(spark, sf_dir, "orders"), table(spark, sf_dir, "events"), USER_PAIR, ["ts", "event_id"], ["o_orderkey"]
    )
    return rows.select("o_orderkey", "o_custkey", "event_id", "event_type", "value")


@register("feature_preagg", f"""
SELECT o_orderkey, o_custkey, events, total, types FROM orders LEFT JOIN (
  SELECT user_id, count(*) AS events, count(DISTINCT event_type) AS types,
         {sql_money('value')} AS total
  FROM events GROUP BY user_id) ON o_custkey = user_id
""")
def feature_preagg(spark, sf_dir):
    summary = [F.count(F.lit(1)).alias("events"), money_sum(F.col("value")).alias("total"),
               F.count_distinct("event_type").alias("types")]
    rows = remedies.join_summary(
        table(spark, sf_dir, "orders"), table(spark, sf_dir, "events"), USER_PAIR, summary, ["o_orderkey"]
    )
    return rows.select("o_orderkey", "o_custkey", "events", "total", "types")


@register("feature_interval_join", """
WITH e AS (SELECT event_id, user_id, event_type, epoch_us(ts) AS at_micro FROM events)
SELECT p.event_id, p.user_id, p.at_micro, count(v.event_id) AS matches
FROM e p LEFT JOIN e v ON v.event_type <> 'purchase' AND p.user_id = v.user_id
  AND v.at_micro BETWEEN p.at_micro - 86400000000 AND p.at_micro
WHERE p.event_type = 'purchase' GROUP BY ALL
""")
def feature_interval_join(spark, sf_dir):
    bought, other = _purchases_and_others(spark, sf_dir)
    return intervals.count_within(
        bought, other.drop("event_type", "value"), ["user_id"], "at_micro", "at_micro", 86400, spread_by=["event_id"]
    )


def _purchases_and_others(spark, sf_dir):
    events = table(spark, sf_dir, "events").select(
        "event_id", "user_id", "event_type", "value", F.unix_micros(F.col("ts").cast("timestamp")).alias("at_micro")
    )
    bought = events.filter("event_type = 'purchase'").select("event_id", "user_id", "at_micro")
    return bought, events.filter("event_type <> 'purchase'").drop("event_id")


@register("feature_latest_join", """
WITH e AS (SELECT event_id, user_id, event_type, value, epoch_us(ts) AS at_micro FROM events),
m AS (SELECT p.event_id, max((v.at_micro, v.event_type, v.value)) AS best
      FROM e p JOIN e v ON v.event_type <> 'purchase' AND p.user_id = v.user_id
        AND v.at_micro BETWEEN p.at_micro - 86400000000 AND p.at_micro
      WHERE p.event_type = 'purchase' GROUP BY p.event_id)
SELECT p.event_id, p.user_id, p.at_micro, best[1] AS feature_micro, best[2] AS event_type, best[3] AS value
FROM e p LEFT JOIN m USING (event_id) WHERE p.event_type = 'purchase'
""")
def feature_latest_join(spark, sf_dir):
    bought, other = _purchases_and_others(spark, sf_dir)
    return intervals.latest_within(
        bought, other.withColumnRenamed("at_micro", "feature_micro"), ["user_id"], "at_micro", "feature_micro", 86400,
        spread_by=["event_id"]
    )


# --- enrichment aggregates --------------------------------------------------

@register("low_freq_agg", f"""
WITH {JOINED}
SELECT {GROUPS}, CAST(NULL AS INTEGER) AS salt, 'low_frequency_hash' AS branch, {METRICS}
FROM joined WHERE NOT is_high_frequency GROUP BY {GROUP_BY}
""")
def low_freq_agg(spark, sf_dir):
    return enrichment.low_frequency(enrichment.enrich(roles.job_inputs(spark, sf_dir)))


MURMUR = roles.sql_murmur_salts("joined", "bid_request_id")
HIGH_SQL = f"""
SELECT {GROUPS}, salt, 'high_frequency_salted' AS branch, {METRICS}
FROM joined JOIN salts USING (bid_request_id) WHERE is_high_frequency GROUP BY {GROUP_BY}, salt
"""


@register("high_freq_salted_agg", f"WITH {JOINED}, {MURMUR} {HIGH_SQL}")
def high_freq_salted_agg(spark, sf_dir):
    return enrichment.high_frequency(enrichment.enrich(roles.job_inputs(spark, sf_dir)))


@register("salt_merge_agg", f"""
WITH {JOINED} SELECT {GROUPS}, {METRICS} FROM joined WHERE is_high_frequency GROUP BY {GROUP_BY}
""")
def salt_merge_agg(spark, sf_dir):
    return enrichment.merged_output(enrichment.enrich(roles.job_inputs(spark, sf_dir)))


@register("enrichment_final", f"""
WITH {JOINED}, {MURMUR} {HIGH_SQL}
UNION ALL
SELECT {GROUPS}, CAST(NULL AS INTEGER) AS salt, 'low_frequency_hash' AS branch, {METRICS}
FROM joined WHERE NOT is_high_frequency GROUP BY {GROUP_BY}
""")
def enrichment_final(spark, sf_dir):
    return enrichment.final_output(roles.job_inputs(spark, sf_dir))


PORTABLE = "CAST(CAST('0x' || substr(md5(CAST(bid_request_id AS VARCHAR)), 1, 8) AS BIGINT) % 16 AS INTEGER)"


@register("enrichment_final_portable", f"""
WITH {JOINED}
SELECT {GROUPS}, CASE WHEN is_high_frequency THEN {PORTABLE} END AS salt,
       CASE WHEN is_high_frequency THEN 'high_frequency_salted' ELSE 'low_frequency_hash' END AS branch, {METRICS}
FROM joined WHERE is_high_frequency IS NOT NULL GROUP BY {GROUP_BY}, 7, 8
""")
def enrichment_final_portable(spark, sf_dir):
    return enrichment.final_output(
        roles.job_inputs(spark, sf_dir), salt=s.portable_salt("bid_request_id", fv.SALT_BUCKETS)
    )


PIPELINE_COUNTS = f"""
SELECT 'enrichment' AS section, unnest(['source_bids_count', 'source_impressions_count', 'source_contextual_count',
    'source_advertiser_count', 'source_koa_settings_count', 'source_eligible_user_data_count',
    'source_feature_log_count', 'source_sib_count']) AS name,
  unnest([(SELECT count(*) FROM bids), (SELECT count(*) FROM impressions), (SELECT count(*) FROM contextual),
    (SELECT count(*) FROM advertiser), (SELECT count(*) FROM settings), (SELECT count(*) FROM eligible),
    (SELECT count(*) FROM features), (SELECT count(DISTINCT user_id_hash) FROM sib)]) AS value
UNION ALL
SELECT 'enrichment', unnest(['joined_row_count', 'joined_impression_match_count', 'joined_eligible_user_match_count',
    'joined_feature_log_match_count', 'joined_sib_match_count', 'high_frequency_joined_count',
    'low_frequency_joined_count']),
  unnest([count(*), count(impression_id), count(segment_id), count(feature_event_id), count(sib_group),
    count(*) FILTER (is_high_frequency), count(*) FILTER (NOT is_high_frequency)])
FROM joined
"""


@register("pipeline_metrics", f"""
WITH {JOINED}, {MURMUR}
{PIPELINE_COUNTS}
UNION ALL
SELECT 'enrichment', 'final_output_count', count(*) FROM (
  SELECT DISTINCT {GROUPS}, salt, is_high_frequency FROM joined JOIN salts USING (bid_request_id)
  WHERE is_high_frequency UNION ALL
  SELECT DISTINCT {GROUPS}, NULL, is_high_frequency FROM joined WHERE NOT is_high_frequency)
""")
def pipeline_metrics(spark, sf_dir):
    return enrichment.run_job(roles.job_inputs(spark, sf_dir), work_folder(spark, "final"))


@register("output_audit", f"""
SELECT 'feature_log' AS name, count(*) AS rows, 0 AS duplicate_keys, 0 AS null_keys FROM (WITH {FEATURES} SELECT * FROM features)
UNION ALL
SELECT 'eligible_user_data', count(*), 0, 0 FROM (WITH {ELIGIBLE} SELECT * FROM eligible)
UNION ALL
SELECT 'final_output', count(*), 0, 0 FROM ({ORACLES["enrichment_final"]})
""")
def output_audit(spark, sf_dir):
    """What the three jobs check before they publish."""
    features = converters.convert_features(roles.feature_log(spark, sf_dir))
    eligible = converters.convert_eligible(roles.matched_users(spark, sf_dir))
    final = enrichment.final_output(roles.job_inputs(spark, sf_dir))
    jobs = ((features, "feature_log", ["feature_event_id"]),
            (eligible, "eligible_user_data", ["bid_request_id", "normalized_user_id"]),
            (final, "final_output", enrichment.OUTPUT_KEYS))
    return reduce(DataFrame.unionByName, [quality.audit_report(df, name, keys) for df, name, keys in jobs])
