"""Synthetic datasets built over the ids of the given tables, so they grow with them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bidloom.registry.base import register, table
from bidloom.sources import synthetic
from bidloom.sources.synthetic import Run

RUN = Run()
USER = "CASE WHEN id % 100 < 20 THEN 'hot_user_' || (id % 1000) ELSE 'user_' || id END"
ADVERTISER = "CASE WHEN id % 100 < 45 THEN id % 5 ELSE id % 1000 END"
CONTEXT = "CASE WHEN id % 100 < 35 THEN id % 100 ELSE id % 20000 END"
DAY = "'2026' AS year, '05' AS month, '21' AS day"


def _time(hour: str) -> str:
    return f"TIMESTAMP '2026-05-21 {hour}:00:00' + to_seconds(id % 3600)"


def _ids(spark, sf_dir, name: str, key: str) -> DataFrame:
    return table(spark, sf_dir, name).select(F.col(key).alias("id"))


@register("gen_advertiser", f"""
SELECT id AS advertiser_id, 'advertiser_' || id AS advertiser_name, 'vertical_' || (id % 25) AS vertical,
       CASE WHEN id % 10 = 0 THEN 'high' ELSE 'standard' END AS priority_tier, id % 13 <> 0 AS is_active, {DAY}
FROM (SELECT s_suppkey AS id FROM supplier)
""")
def gen_advertiser(spark, sf_dir):
    return synthetic.advertisers(_ids(spark, sf_dir, "supplier", "s_suppkey"), RUN)


@register("gen_koa_settings", f"""
SELECT id % 1000 AS advertiser_id, id % 50000 AS campaign_id, 'koa_group_' || (id % 20) AS koa_group,
       CAST(id % 100 AS DOUBLE) / 100 AS bid_modifier,
       CASE WHEN id % 7 = 0 THEN 'strict' ELSE 'normal' END AS policy_mode, {DAY}
FROM (SELECT c_custkey AS id FROM customer)
""")
def gen_koa_settings(spark, sf_dir):
    return synthetic.settings(_ids(spark, sf_dir, "customer", "c_custkey"), RUN)


@register("gen_contextual", f"""
SELECT id AS contextual_id, 'domain_' || (id % 50000) || '.example' AS domain,
       'category_' || (id % 200) AS content_category, id % 100 < 35 AS is_hot_context,
       CAST(id % 1000 AS DOUBLE) / 1000 AS context_score, {DAY}, '10' AS hour
FROM (SELECT p_partkey AS id FROM part)
""")
def gen_contextual(spark, sf_dir):
    return synthetic.contexts(_ids(spark, sf_dir, "part", "p_partkey"), RUN)


@register("gen_bids", f"""
SELECT *, sha256(user_id) AS user_id_hash, {DAY}, '10' AS hour FROM (
  SELECT 'br_' || id AS bid_request_id, {USER} AS user_id, {ADVERTISER} AS advertiser_id, id % 50000 AS campaign_id,
         {CONTEXT} AS contextual_id, {_time('10')} AS bid_timestamp,
         CAST(0.2 AS DOUBLE) + CAST(id % 500 AS DOUBLE) / 100 AS bid_price, 'device_' || (id % 6) AS device_type,
         'geo_' || (id % 250) AS geo_id, CAST(id % 500 AS INTEGER) AS daily_user_freq,
         CASE WHEN id % 100 < 20 THEN 'high' ELSE 'low' END AS frequency_bracket, id % 11 = 0 AS is_test_bid
  FROM (SELECT o_orderkey AS id FROM orders))
""")
def gen_bids(spark, sf_dir):
    return synthetic.bids(_ids(spark, sf_dir, "orders", "o_orderkey"), RUN)


def _impressions_sql(first: int, hour: str, kind: str) -> str:
    return f"""
SELECT 'imp_' || (id + {first}) AS impression_id, 'br_' || (id + {first}) AS bid_request_id,
       {_time(hour)} AS feedback_timestamp, id % 20 <> 0 AS is_billable,
       CAST(0.1 AS DOUBLE) + CAST(id % 300 AS DOUBLE) / 100 AS clearing_price, '{kind}' AS feedback_type, {DAY},
       '{hour}' AS hour
FROM (SELECT o_orderkey AS id FROM orders)
"""


@register("gen_impressions_same_hour", _impressions_sql(0, "10", "same_hour"))
def gen_impressions_same_hour(spark, sf_dir):
    return synthetic.impressions(_ids(spark, sf_dir, "orders", "o_orderkey"), RUN)


@register("gen_impressions_late", _impressions_sql(59500, "11", "late_n_plus_1"))
def gen_impressions_late(spark, sf_dir):
    return synthetic.impressions(_ids(spark, sf_dir, "orders", "o_orderkey"), RUN, late=True)


@register("gen_matched_user_data", f"""
SELECT *, sha256(user_id) AS user_id_hash, {DAY}, '10' AS hour FROM (
  SELECT 'br_' || id AS bid_request_id, {USER} AS user_id, 'segment_' || (id % 500) AS segment_id,
         id % 4 = 0 AS is_eligible, CAST(id % 100 AS INTEGER) AS eligibility_score
  FROM (SELECT o_orderkey AS id FROM orders))
""")
def gen_matched_user_data(spark, sf_dir):
    return synthetic.matched_users(_ids(spark, sf_dir, "orders", "o_orderkey"), RUN)


@register("gen_feature_log", f"""
SELECT *, sha256(user_id) AS user_id_hash, {DAY}, '10' AS hour FROM (
  SELECT 'feature_event_' || id AS feature_event_id, {USER} AS user_id, {CONTEXT} AS contextual_id,
         'feature_' || (id % 300) AS feature_name, CAST(id % 1000 AS DOUBLE) / 1000 AS feature_value,
         {_time('10')} AS event_timestamp
  FROM (SELECT event_id AS id FROM events))
""")
def gen_feature_log(spark, sf_dir):
    return synthetic.features(_ids(spark, sf_dir, "events", "event_id"), RUN)


@register("gen_sib", f"""
SELECT *, sha256(user_id) AS user_id_hash, {DAY} FROM (
  SELECT {USER} AS user_id, 'sib_group_' || (id % 100) AS sib_group, CAST(id % 1000 AS DOUBLE) / 1000 AS sib_score,
         CASE WHEN id % 8 = 0 THEN 'lookback' ELSE 'current' END AS sib_source
  FROM (SELECT c_custkey AS id FROM customer))
""")
def gen_sib(spark, sf_dir):
    return synthetic.sib(_ids(spark, sf_dir, "customer", "c_custkey"), RUN)
