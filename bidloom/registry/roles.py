"""The given tables in the roles of the ad-event datasets, as DataFrames and as SQL text.

bids: order lines with their order. impressions: returned or accepted lines, open ones being late. contextual:
part sizes in steps of five, matching line quantities. advertiser and settings: suppliers. matched users:
finished orders. feature log: events. sib: customers. Hot users are every fifth customer key, and user ids carry
capitals and blanks, so that normalising matters.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bidloom.functions.scalars import normalize_id, sha256_hex
from bidloom.plans import converters
from bidloom.plans.enrichment import ELIGIBLE_READ, FEATURES_READ, Inputs
from bidloom.registry.base import table


def user_id(key: str) -> Column:
    prefix = F.when(F.col(key) % 5 == 0, F.lit("Hot_User_")).otherwise(F.lit(" User_"))
    return F.concat(prefix, F.col(key).cast("string"), F.lit(" "))


def _hours(ts: str) -> dict[str, Column]:
    formats = {"year": "yyyy", "month": "MM", "day": "dd", "hour": "HH"}
    return {name: F.date_format(ts, form) for name, form in formats.items()}


def bids(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderpriority")
    rows = table(spark, sf_dir, "lineitem").join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    bracket = (
        F.when(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"), F.lit("high"))
        .when(F.col("o_orderpriority") != "4-NOT SPECIFIED", F.lit("low"))
    )
    return rows.select(
        F.col("l_orderkey").alias("bid_request_id"),
        user_id("o_custkey").alias("user_id"),
        F.col("l_suppkey").alias("advertiser_id"),
        F.col("l_linenumber").cast("bigint").alias("campaign_id"),
        F.floor(F.col("l_quantity") / 5).alias("contextual_id"),
        F.col("l_shipdate").alias("bid_timestamp"),
        (F.col("l_extendedprice") / 10000.0).alias("bid_price"),
        F.concat(F.lit("device_"), "l_returnflag").alias("device_type"),
        F.concat(F.lit("geo_"), "l_linestatus").alias("geo_id"),
        F.col("l_linenumber").alias("daily_user_freq"),
        bracket.alias("frequency_bracket"),
        (F.col("l_returnflag") == "R").alias("is_test_bid"),
    ).withColumns({"user_id_hash": sha256_hex("user_id"), **_hours("bid_timestamp")})


def impressions(spark: SparkSession, sf_dir: str, late: bool) -> DataFrame:
    status, kind = ("O", "late_n_plus_1") if late else ("F", "same_hour")
    lines = table(spark, sf_dir, "lineitem").filter((F.col("l_returnflag") != "N") & (F.col("l_linestatus") == status))
    return lines.select(
        F.concat_ws("_", F.lit("imp"), "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber").alias("impression_id"),
        F.col("l_orderkey").alias("bid_request_id"),
        F.col("l_shipdate").alias("feedback_timestamp"),
        (F.col("l_tax") > 0).alias("is_billable"),
        (F.col("l_extendedprice") * (1 - F.col("l_discount")) / 10000.0).alias("clearing_price"),
        F.lit(kind).alias("feedback_type"),
    )


def contextual(spark: SparkSession, sf_dir: str) -> DataFrame:
    step = F.floor(F.col("p_size") / 5).alias("contextual_id")
    return table(spark, sf_dir, "part").groupBy(step).agg(
        F.min("p_brand").alias("domain"),
        F.min("p_type").alias("content_category"),
        (F.min("p_size") < 10).alias("is_hot_context"),
        F.max("p_retailprice").alias("context_score"),
    )


def advertiser(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("advertiser_id"),
        F.col("s_name").alias("advertiser_name"),
        F.concat(F.lit("vertical_"), "s_nationkey").alias("vertical"),
        F.when(F.col("s_acctbal") > 5000, F.lit("high")).otherwise(F.lit("standard")).alias("priority_tier"),
        (F.col("s_acctbal") >= 0).alias("is_active"),
    )


def settings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("advertiser_id"),
        F.col("s_nationkey").cast("bigint").alias("campaign_id"),
        F.concat(F.lit("koa_group_"), (F.col("s_nationkey") % 20).cast("string")).alias("koa_group"),
        (F.floor(F.col("s_acctbal") / 100) / 100.0).alias("bid_modifier"),
        F.when(F.col("s_acctbal") < 1000, F.lit("strict")).otherwise(F.lit("normal")).alias("policy_mode"),
    )


def matched_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = table(spark, sf_dir, "orders").filter(F.col("o_orderstatus") == "F")
    return done.select(
        F.col("o_orderkey").alias("bid_request_id"),
        user_id("o_custkey").alias("user_id"),
        F.concat(F.lit("segment_"), "o_orderpriority").alias("segment_id"),
        (F.col("o_totalprice") > 250000).alias("is_eligible"),
        F.floor(F.col("o_totalprice") / 5000).cast("int").alias("eligibility_score"),
        "o_orderdate",
    ).withColumns({"user_id_hash": sha256_hex("user_id"), **_hours("o_orderdate")}).drop("o_orderdate")


def feature_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.get_json_object("props", "$.k").cast("int")
    return table(spark, sf_dir, "events").select(
        F.concat(F.lit("feature_event_"), "event_id").alias("feature_event_id"),
        user_id("user_id").alias("user_id"),
        F.floor(k / 10).alias("contextual_id"),
        F.col("event_type").alias("feature_name"),
        (k / 100.0).alias("feature_value"),
        F.col("ts").alias("event_timestamp"),
    ).withColumns({"user_id_hash": sha256_hex("user_id"), **_hours("event_timestamp")})


def sib(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(
        user_id("c_custkey").alias("user_id"),
        F.col("c_mktsegment").alias("sib_group"),
        (F.col("c_acctbal") / 10000.0).alias("sib_score"),
        F.when(F.col("c_acctbal") < 0, F.lit("lookback")).otherwise(F.lit("current")).alias("sib_source"),
    ).withColumn("user_id_hash", sha256_hex(normalize_id("user_id")))


def raw_inputs(spark: SparkSession, sf_dir: str) -> Inputs:
    return Inputs(
        bids=bids(spark, sf_dir),
        impressions_same=impressions(spark, sf_dir, late=False),
        impressions_late=impressions(spark, sf_dir, late=True),
        contextual=contextual(spark, sf_dir),
        advertiser=advertiser(spark, sf_dir),
        settings=settings(spark, sf_dir),
        eligible=matched_users(spark, sf_dir),
        features=feature_log(spark, sf_dir),
        sib=sib(spark, sf_dir),
    )


def job_inputs(spark: SparkSession, sf_dir: str) -> Inputs:
    """The raw tables with both converters applied, for the columns that the job reads."""
    raw = raw_inputs(spark, sf_dir)
    return replace(
        raw,
        eligible=converters.convert_eligible(raw.eligible, ELIGIBLE_READ),
        features=converters.convert_features(raw.features, FEATURES_READ),
    )


# --- the same in SQL --------------------------------------------------------

def _sql_user(key: str) -> str:
    return f"CASE WHEN {key} % 5 = 0 THEN 'Hot_User_' ELSE ' User_' END || {key} || ' '"


def _sql_hours(ts: str) -> str:
    forms = {"year": "%Y", "month": "%m", "day": "%d", "hour": "%H"}
    return ", ".join(f"strftime({ts}, '{form}') AS {name}" for name, form in forms.items())


def _sql_uuid(text: str) -> str:
    return (f"regexp_replace(md5({text}), '^(.{{8}})(.{{4}})(.{{4}})(.{{4}})(.{{12}})$', "
            r"'\1-\2-\3-\4-\5')")


def sql_floor(ts: str) -> str:
    return f"make_timestamp(CAST(floor(epoch({ts}) / 300) * 300 AS BIGINT) * 1000000)"


RAW_BIDS = f"""
raw_bids AS (
  SELECT *, sha256(user_id) AS user_id_hash, {_sql_hours('bid_timestamp')} FROM (
    SELECT l_orderkey AS bid_request_id, {_sql_user('o_custkey')} AS user_id, l_suppkey AS advertiser_id,
           CAST(l_linenumber AS BIGINT) AS campaign_id, CAST(floor(l_quantity / 5) AS BIGINT) AS contextual_id,
           l_shipdate AS bid_timestamp, l_extendedprice / 10000.0 AS bid_price,
           'device_' || l_returnflag AS device_type, 'geo_' || l_linestatus AS geo_id,
           l_linenumber AS daily_user_freq,
           CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'high'
                WHEN o_orderpriority <> '4-NOT SPECIFIED' THEN 'low' END AS frequency_bracket,
           l_returnflag = 'R' AS is_test_bid
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey))"""

RAW_IMPRESSIONS = """
raw_impressions AS (
  SELECT 'imp_' || l_orderkey || '_' || l_partkey || '_' || l_suppkey || '_' || l_linenumber AS impression_id,
         l_orderkey AS bid_request_id, l_shipdate AS feedback_timestamp, l_tax > 0 AS is_billable,
         l_extendedprice * (1 - l_discount) / 10000.0 AS clearing_price,
         CASE l_linestatus WHEN 'O' THEN 'late_n_plus_1' ELSE 'same_hour' END AS feedback_type
  FROM lineitem WHERE l_returnflag <> 'N')"""

IMPRESSIONS = RAW_IMPRESSIONS + """,
impressions AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY bid_request_id ORDER BY feedback_timestamp DESC, impression_id DESC,
           is_billable DESC, clearing_price DESC, feedback_type DESC) AS rn FROM raw_impressions) WHERE rn = 1)"""

CONTEXTUAL = """
contextual AS (
  SELECT CAST(floor(p_size / 5) AS BIGINT) AS contextual_id, min(p_brand) AS domain, min(p_type) AS content_category,
         min(p_size) < 10 AS is_hot_context, max(p_retailprice) AS context_score
  FROM part GROUP BY 1)"""

ADVERTISER = """
advertiser AS (
  SELECT s_suppkey AS advertiser_id, s_name AS advertiser_name, 'vertical_' || s_nationkey AS vertical,
         CASE WHEN s_acctbal > 5000 THEN 'high' ELSE 'standard' END AS priority_tier, s_acctbal >= 0 AS is_active
  FROM supplier)"""

SETTINGS = """
settings AS (
  SELECT s_suppkey AS advertiser_id, CAST(s_nationkey AS BIGINT) AS campaign_id,
         'koa_group_' || (s_nationkey % 20) AS koa_group, floor(s_acctbal / 100) / 100.0 AS bid_modifier,
         CASE WHEN s_acctbal < 1000 THEN 'strict' ELSE 'normal' END AS policy_mode
  FROM supplier)"""

RAW_MATCHED = f"""
raw_matched AS (
  SELECT * EXCLUDE (o_orderdate), sha256(user_id) AS user_id_hash, {_sql_hours('o_orderdate')} FROM (
    SELECT o_orderkey AS bid_request_id, {_sql_user('o_custkey')} AS user_id,
           'segment_' || o_orderpriority AS segment_id, o_totalprice > 250000 AS is_eligible,
           CAST(floor(o_totalprice / 5000) AS INTEGER) AS eligibility_score, o_orderdate
    FROM orders WHERE o_orderstatus = 'F'))"""

RAW_FEATURES = f"""
raw_features AS (
  SELECT *, sha256(user_id) AS user_id_hash, {_sql_hours('event_timestamp')} FROM (
    SELECT 'feature_event_' || event_id AS feature_event_id, {_sql_user('user_id')} AS user_id,
           CAST(floor(CAST(props->>'$.k' AS INTEGER) / 10) AS BIGINT) AS contextual_id, event_type AS feature_name,
           CAST(props->>'$.k' AS INTEGER) / 100.0 AS feature_value, ts AS event_timestamp
    FROM events))"""

SIB = f"""
sib AS (
  SELECT *, sha256(lower(trim(user_id))) AS user_id_hash FROM (
    SELECT {_sql_user('c_custkey')} AS user_id, c_mktsegment AS sib_group, c_acctbal / 10000.0 AS sib_score,
           CASE WHEN c_acctbal < 0 THEN 'lookback' ELSE 'current' END AS sib_source FROM customer))"""

FEATURES = RAW_FEATURES + f""",
features AS (
  SELECT feature_event_id, user_id, lower(trim(user_id)) AS normalized_user_id, user_id_hash AS source_user_id_hash,
         sha256(lower(trim(user_id))) AS user_id_hash, {_sql_uuid('lower(trim(user_id))')} AS user_uuid,
         contextual_id, sha256(CAST(contextual_id AS VARCHAR)) AS contextual_join_key, feature_name, feature_value,
         CASE WHEN feature_value >= 0.75 THEN 'very_high' WHEN feature_value >= 0.5 THEN 'high'
              WHEN feature_value >= 0.25 THEN 'medium' ELSE 'low' END AS feature_value_bucket,
         event_timestamp, {sql_floor('event_timestamp')} AS rounded_event_time, year, month, day, hour
  FROM raw_features)"""

ELIGIBLE = RAW_MATCHED + f""",
eligible AS (
  SELECT bid_request_id, sha256(CAST(bid_request_id AS VARCHAR)) AS bid_request_hash, user_id,
         lower(trim(user_id)) AS normalized_user_id, user_id_hash AS source_user_id_hash,
         sha256(lower(trim(user_id))) AS user_id_hash, {_sql_uuid('lower(trim(user_id))')} AS user_uuid, segment_id,
         is_eligible, CASE WHEN is_eligible THEN 1 ELSE 0 END AS eligible_user_flag, eligibility_score,
         CASE WHEN eligibility_score >= 75 THEN 'very_high' WHEN eligibility_score >= 50 THEN 'high'
              WHEN eligibility_score >= 25 THEN 'medium' ELSE 'low' END AS eligibility_band,
         CASE WHEN starts_with(lower(trim(user_id)), 'hot_user_') THEN 'high' ELSE 'low' END AS frequency_bracket,
         year, month, day, hour
  FROM raw_matched)"""

BIDS = RAW_BIDS + f""",
bids AS (
  SELECT bid_request_id, sha256(CAST(bid_request_id AS VARCHAR)) AS bid_request_hash, user_id,
         lower(trim(user_id)) AS normalized_user_id, user_id_hash AS source_user_id_hash,
         sha256(lower(trim(user_id))) AS user_id_hash, advertiser_id, campaign_id, contextual_id,
         sha256(CAST(contextual_id AS VARCHAR)) AS contextual_join_key, bid_timestamp,
         {sql_floor('bid_timestamp')} AS rounded_bid_time, bid_price,
         CASE WHEN bid_price >= 4.0 THEN 'premium' WHEN bid_price >= 2.0 THEN 'standard' ELSE 'low' END
           AS bid_price_bucket, device_type, geo_id, daily_user_freq, frequency_bracket AS bid_frequency_bracket,
         CASE WHEN is_test_bid THEN 0.1 WHEN bid_price >= 4.0 THEN 0.95 ELSE 0.7 END AS event_quality_score,
         advertiser_id || ':' || campaign_id AS campaign_grouping_key, year, month, day, hour
  FROM raw_bids)"""

# All seven joins written out, one row per feature match.
JOINED = ",".join([BIDS, IMPRESSIONS, CONTEXTUAL, ADVERTISER, SETTINGS, ELIGIBLE, FEATURES, SIB]) + """,
joined AS (
  SELECT *, final_frequency_bracket = 'high' AS is_high_frequency,
         bid_price * effective_bid_modifier AS adjusted_bid_price,
         bid_price * effective_bid_modifier * event_quality_score AS quality_weighted_price
  FROM (
    SELECT b.*, i.impression_id, i.clearing_price, c.content_category, a.vertical, s.koa_group, s.bid_modifier,
           s.policy_mode, e.segment_id, e.eligible_user_flag, f.feature_event_id, sb.sib_group, sb.sib_score,
           coalesce(e.frequency_bracket, b.bid_frequency_bracket) AS final_frequency_bracket,
           coalesce(s.bid_modifier, 1.0) AS effective_bid_modifier
    FROM bids b
    LEFT JOIN impressions i ON b.bid_request_id = i.bid_request_id
    LEFT JOIN contextual c ON b.contextual_id = c.contextual_id
    LEFT JOIN advertiser a ON b.advertiser_id = a.advertiser_id
    LEFT JOIN settings s ON b.advertiser_id = s.advertiser_id AND b.campaign_id = s.campaign_id
    LEFT JOIN eligible e ON b.bid_request_id = e.bid_request_id AND b.user_id_hash = e.user_id_hash
    LEFT JOIN features f ON b.user_id_hash = f.user_id_hash AND b.contextual_id = f.contextual_id
    LEFT JOIN (SELECT DISTINCT user_id_hash, sib_group, sib_score, sib_source FROM sib) sb
      ON b.user_id_hash = sb.user_id_hash))"""


def sql_units(value: str) -> str:
    """Units of the twelfth place, whole part and fraction apart."""
    return (f"(CAST(trunc({value}) AS HUGEINT) * 1000000000000 "
            f"+ CAST(floor(({value} - trunc({value})) * 1e12 + 0.5) AS HUGEINT))")


def sql_money(value: str) -> str:
    """Exact sum at twelve places, rounded once to two."""
    total = f"sum({sql_units(f'({value})')})"
    return f"CAST(sign({total}) * ((abs({total}) + 5000000000) // 10000000000) AS DOUBLE) / 100"


def sql_mean(value: str) -> str:
    """Mean from an exact sum at twelve places."""
    total = f"sum({sql_units(value)})"
    return f"CAST({total} AS DOUBLE) / nullif(CAST(count({value}) AS DOUBLE) * 1e12, 0)"


METRICS = f"""
  CAST(count(*) AS BIGINT) AS event_count, count(DISTINCT bid_request_id) AS bid_count,
  count(impression_id) AS impression_count,
  CAST(sum(coalesce(eligible_user_flag, 0)) AS BIGINT) AS eligible_user_count,
  count(feature_event_id) AS feature_event_count,
  {sql_mean('bid_price')} AS avg_bid_price, {sql_mean('clearing_price')} AS avg_clearing_price,
  {sql_mean('quality_weighted_price')} AS avg_quality_weighted_price, {sql_mean('sib_score')} AS avg_sib_score"""


def sql_murmur_salts(source: str, key: str, buckets: int = 16) -> str:
    """A CTE `salts(key, salt)`: 32-bit Murmur3 of a non-negative bigint with seed 42, step by step."""
    def times(x: str, factor: int) -> str:
        return f"CAST((CAST({x} AS HUGEINT) * {factor}) % 4294967296 AS BIGINT)"

    def rotl(x: str, bits: int) -> str:
        return f"((({x}) << {bits}) & 4294967295) | (({x}) >> {32 - bits})"

    steps = [f"SELECT DISTINCT {key}, {key} & 4294967295 AS word, CAST(42 AS BIGINT) AS h FROM {source}"]
    for _ in range(2):
        steps += [
            f"SELECT *, {times('word', 0xCC9E2D51)} AS k1 FROM ({steps[-1]})",
        ]
        steps += [f"SELECT *, {rotl('k1', 15)} AS k2 FROM ({steps[-1]})"]
        steps += [f"SELECT *, {times('k2', 0x1B873593)} AS k3 FROM ({steps[-1]})"]
        steps += [f"SELECT *, xor(h, k3) AS h1 FROM ({steps[-1]})"]
        steps += [f"SELECT *, {rotl('h1', 13)} AS h2 FROM ({steps[-1]})"]
        steps += [f"SELECT {key}, ({key} >> 32) & 4294967295 AS word, "
                  f"(h2 * 5 + {0xE6546B64}) % 4294967296 AS h FROM ({steps[-1]})"]
    steps += [f"SELECT {key}, xor(h, 8) AS h FROM ({steps[-1]})"]
    for shift, factor in ((16, 0x85EBCA6B), (13, 0xC2B2AE35)):
        steps += [f"SELECT {key}, xor(h, h >> {shift}) AS h FROM ({steps[-1]})"]
        steps += [f"SELECT {key}, {times('h', factor)} AS h FROM ({steps[-1]})"]
    steps += [f"SELECT {key}, xor(h, h >> 16) AS h FROM ({steps[-1]})"]
    signed = "CASE WHEN h >= 2147483648 THEN h - 4294967296 ELSE h END"
    return f"salts AS (SELECT {key}, CAST(abs({signed}) % {buckets} AS INTEGER) AS salt FROM ({steps[-1]}))"
