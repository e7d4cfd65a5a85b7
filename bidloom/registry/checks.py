"""Registered data checks and diagnosis reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from bidloom.operators import quality
from bidloom.plans import contract, enrichment
from bidloom.registry import roles
from bidloom.registry.base import ORACLES, register, table
from bidloom.registry.roles import (
    ADVERTISER, BIDS, CONTEXTUAL, ELIGIBLE, IMPRESSIONS, JOINED, RAW_BIDS, RAW_FEATURES, RAW_IMPRESSIONS, RAW_MATCHED,
    SETTINGS, SIB,
)

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()


@register("table_counts", " UNION ALL ".join(
    f"SELECT 'counts' AS section, '{name}' AS name, count(*) AS value FROM {name}" for name in TABLES
))
def table_counts(spark, sf_dir):
    return quality.row_counts({name: table(spark, sf_dir, name) for name in TABLES})


@register("contract_counts", f"""
WITH {RAW_BIDS}, {RAW_IMPRESSIONS}, {CONTEXTUAL}, {RAW_MATCHED}, {ADVERTISER}, {SETTINGS}, {RAW_FEATURES}, {SIB}
SELECT 'counts' AS section, unnest(['bids', 'impressions_feedback_same_hour', 'impressions_feedback_late_hour',
    'impressions_feedback_total', 'contextual', 'matched_user_data', 'advertiser', 'koa_settings', 'feature_log',
    'sib']) AS name,
  unnest([(SELECT count(*) FROM raw_bids),
    (SELECT count(*) FROM raw_impressions WHERE feedback_type = 'same_hour'),
    (SELECT count(*) FROM raw_impressions WHERE feedback_type <> 'same_hour'),
    (SELECT count(*) FROM raw_impressions), (SELECT count(*) FROM contextual), (SELECT count(*) FROM raw_matched),
    (SELECT count(*) FROM advertiser), (SELECT count(*) FROM settings), (SELECT count(*) FROM raw_features),
    (SELECT count(*) FROM sib)]) AS value
""")
def contract_counts(spark, sf_dir):
    return contract.dataset_counts(roles.raw_inputs(spark, sf_dir))


def _overlap(name: str, left: str, right: str, keys: str) -> str:
    complete = " AND ".join(f"{k} IS NOT NULL" for k in keys.split(", "))
    return (f"SELECT 'overlap' AS section, '{name}' AS name, count(*) AS value FROM ("
            f"SELECT {keys} FROM {left} WHERE {complete} INTERSECT SELECT {keys} FROM {right})")


@register("key_overlap", f"""
WITH {RAW_BIDS}, {RAW_IMPRESSIONS}, {CONTEXTUAL}, {RAW_MATCHED}, {ADVERTISER}, {SETTINGS}, {RAW_FEATURES}, {SIB}
""" + " UNION ALL ".join([
    _overlap("bids_to_impressions_bid_request_id", "raw_bids", "raw_impressions", "bid_request_id"),
    _overlap("bids_to_matched_user_data_bid_request_id", "raw_bids", "raw_matched", "bid_request_id"),
    _overlap("bids_to_advertiser_advertiser_id", "raw_bids", "advertiser", "advertiser_id"),
    _overlap("bids_to_contextual_contextual_id", "raw_bids", "contextual", "contextual_id"),
    _overlap("bids_to_feature_log_user_id_hash", "raw_bids", "raw_features", "user_id_hash"),
    _overlap("bids_to_sib_user_id_hash", "raw_bids", "sib", "user_id_hash"),
    _overlap("bids_to_koa_settings_advertiser_campaign", "raw_bids", "settings", "advertiser_id, campaign_id"),
    _overlap("bids_to_feature_log_user_context", "raw_bids", "raw_features", "user_id_hash, contextual_id"),
]))
def key_overlap(spark, sf_dir):
    return contract.overlaps(roles.raw_inputs(spark, sf_dir))


@register("key_overlap_sketch", f"SELECT *, true AS within_error FROM ({ORACLES['key_overlap']})")
def key_overlap_sketch(spark, sf_dir):
    """The exact overlaps beside their estimates, which lie within the stated error."""
    raw = roles.raw_inputs(spark, sf_dir)
    both = contract.overlaps(raw).join(contract.overlap_estimates(raw), "name")
    close = F.abs(F.col("estimate") - F.col("value")) <= F.col("error")
    return both.select("section", "name", "value", close.alias("within_error"))


@register("key_overlap_composite", """
SELECT 'overlap' AS section, 'lines_to_suppliers' AS name, count(*) AS value FROM (
  SELECT l_suppkey, l_linenumber FROM lineitem INTERSECT SELECT s_suppkey, s_nationkey FROM supplier)
""")
def key_overlap_composite(spark, sf_dir):
    return quality.key_overlap(
        table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "supplier"),
        [("l_suppkey", "s_suppkey"), ("l_linenumber", "s_nationkey")], "lines_to_suppliers",
    )


@register("skew_indicators", f"""
WITH {RAW_BIDS},
c AS (SELECT 'frequency_bracket' AS indicator, frequency_bracket AS key, count(*) AS rows FROM raw_bids GROUP BY 2
  UNION ALL SELECT 'top_advertiser', CAST(advertiser_id AS VARCHAR), count(*) FROM raw_bids GROUP BY 2
  UNION ALL SELECT 'top_contextual', CAST(contextual_id AS VARCHAR), count(*) FROM raw_bids GROUP BY 2)
SELECT indicator, key, rows FROM (
  SELECT *, row_number() OVER (PARTITION BY indicator ORDER BY rows DESC, key NULLS FIRST) AS rn FROM c) WHERE rn <= 5
""")
def skew_indicators(spark, sf_dir):
    return contract.skew_indicators(roles.bids(spark, sf_dir))


@register("group_counts", "SELECT event_type, count(*) AS rows FROM events GROUP BY event_type")
def group_counts(spark, sf_dir):
    return table(spark, sf_dir, "events").groupBy("event_type").agg(F.count(F.lit(1)).alias("rows"))


@register("distinct_counts", f"""
WITH {IMPRESSIONS}, {RAW_BIDS}
SELECT (SELECT count(*) FROM (SELECT DISTINCT user_id FROM raw_bids)) AS users,
       (SELECT count(*) FROM (SELECT DISTINCT frequency_bracket FROM raw_bids)) AS brackets
""")
def distinct_counts(spark, sf_dir):
    return roles.bids(spark, sf_dir).agg(
        quality.distinct_rows("user_id").alias("users"), quality.distinct_rows("frequency_bracket").alias("brackets")
    )


@register("top_k_keys", """
SELECT l_partkey, count(*) AS rows FROM lineitem GROUP BY l_partkey ORDER BY rows DESC, l_partkey LIMIT 5
""")
def top_k_keys(spark, sf_dir):
    return quality.top_keys(table(spark, sf_dir, "lineitem"), ["l_partkey"], 5)


@register("hot_keys", f"""
WITH {RAW_BIDS}, {SETTINGS},
r AS (SELECT s.koa_group FROM raw_bids b LEFT JOIN settings s
      ON b.advertiser_id = s.advertiser_id AND b.campaign_id = s.campaign_id)
SELECT koa_group, count(*) AS rows, CAST(count(*) AS DOUBLE) / (SELECT count(*) FROM r) AS share,
       koa_group IS NULL AS is_null_or_default
FROM r GROUP BY koa_group ORDER BY rows DESC, koa_group LIMIT 10
""")
def hot_keys(spark, sf_dir):
    rows = roles.bids(spark, sf_dir).join(roles.settings(spark, sf_dir), ["advertiser_id", "campaign_id"], "left")
    return quality.hot_keys(rows, "koa_group", 10)


PROBES = {"impressions": "impression_id", "contextual": "content_category", "settings": "koa_group",
          "eligible": "segment_id", "sib": "sib_group"}


@register("join_match_rates", f"""
WITH {JOINED}, c AS (SELECT count(*) AS rows, {', '.join(f'count({c}) AS {n}' for n, c in PROBES.items())} FROM joined)
SELECT name, rows, matched, CAST(matched AS DOUBLE) / rows AS match_rate FROM (
  SELECT unnest([{', '.join(f"'{n}'" for n in PROBES)}]) AS name, rows, unnest([{', '.join(PROBES)}]) AS matched FROM c)
""")
def join_match_rates(spark, sf_dir):
    rows = enrichment.enrich(roles.job_inputs(spark, sf_dir))
    return quality.match_rates(rows, PROBES, F.col("joined_rows"))


@register("freq_split_counts", f"""
WITH {BIDS}, s AS (SELECT bid_frequency_bracket = 'high' AS is_high FROM bids)
SELECT count(*) AS joined, count(*) FILTER (is_high) AS high, count(*) FILTER (NOT is_high) AS low,
       count(*) FILTER (is_high IS NULL) AS unclassified, CAST(0 AS BIGINT) AS missing
FROM s
""")
def freq_split_counts(spark, sf_dir):
    bids = enrichment.prepare_bids(roles.bids(spark, sf_dir))
    return quality.branch_conservation(
        bids.withColumn("is_high", F.col("bid_frequency_bracket") == "high"), "is_high"
    )


@register("conservation", f"""
WITH {JOINED}
SELECT count(*) AS joined, count(*) FILTER (is_high_frequency) AS high,
       count(*) FILTER (NOT is_high_frequency) AS low, count(*) FILTER (is_high_frequency IS NULL) AS unclassified,
       CAST(0 AS BIGINT) AS missing
FROM joined
""")
def conservation(spark, sf_dir):
    return enrichment.conservation(enrichment.enrich(roles.job_inputs(spark, sf_dir)))


@register("dup_keys", """
SELECT l_orderkey, l_linenumber, count(*) AS copies FROM lineitem GROUP BY ALL HAVING count(*) > 1
""")
def dup_keys(spark, sf_dir):
    return quality.duplicate_keys(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


NULLABLE = ["bid_request_id", "impression_id", "clearing_price", "segment_id", "koa_group", "final_frequency_bracket"]


@register("null_rates", f"""
WITH {BIDS}, {IMPRESSIONS}, {SETTINGS}, {ELIGIBLE},
r AS (SELECT b.bid_request_id, impression_id, clearing_price, segment_id, koa_group,
        coalesce(e.frequency_bracket, b.bid_frequency_bracket) AS final_frequency_bracket
  FROM bids b LEFT JOIN impressions i ON b.bid_request_id = i.bid_request_id
  LEFT JOIN settings s ON b.advertiser_id = s.advertiser_id AND b.campaign_id = s.campaign_id
  LEFT JOIN eligible e ON b.bid_request_id = e.bid_request_id AND b.user_id_hash = e.user_id_hash),
c AS (SELECT count(*) AS rows, {', '.join(f'count(*) - count({c}) AS {c}' for c in NULLABLE)} FROM r)
SELECT column_name, rows, nulls, CAST(nulls AS DOUBLE) / rows AS null_rate FROM (
  SELECT unnest([{', '.join(f"'{c}'" for c in NULLABLE)}]) AS column_name, rows,
         unnest([{', '.join(NULLABLE)}]) AS nulls FROM c)
""")
def null_rates(spark, sf_dir):
    return quality.null_rates(enrichment.enrich(roles.job_inputs(spark, sf_dir)), NULLABLE)


@register("hour_completeness", """
SELECT CAST(ts AS DATE) AS day, count(DISTINCT hour(ts)) AS hours, count(*) AS rows,
       count(DISTINCT hour(ts)) = 24 AS ready_to_process
FROM events GROUP BY 1
""")
def hour_completeness(spark, sf_dir):
    return quality.hour_completeness(table(spark, sf_dir, "events"), "ts")


PROFILE_SQL = """
SELECT 'orders' AS table_name, 'o_custkey' AS join_key, count(*) AS rows, count(DISTINCT o_custkey) AS distinct_keys,
       count(*) - count(o_custkey) AS null_keys FROM orders
UNION ALL SELECT 'customer', 'c_custkey', count(*), count(DISTINCT c_custkey), count(*) - count(c_custkey) FROM customer
UNION ALL SELECT 'events', 'user_id', count(*), count(DISTINCT user_id), count(*) - count(user_id) FROM events
UNION ALL SELECT 'lineitem', 'l_partkey', count(*), count(DISTINCT l_partkey), count(*) - count(l_partkey) FROM lineitem
UNION ALL SELECT 'part', 'p_partkey', count(*), count(DISTINCT p_partkey), count(*) - count(p_partkey) FROM part
"""


def _profile(spark, sf_dir):
    keys = {"orders": "o_custkey", "customer": "c_custkey", "events": "user_id", "lineitem": "l_partkey",
            "part": "p_partkey"}
    return quality.join_key_files({name: (table(spark, sf_dir, name), key) for name, key in keys.items()})


@register("join_key_profile", f"SELECT *, true AS has_files, true AS has_bytes FROM ({PROFILE_SQL})")
def join_key_profile(spark, sf_dir):
    profile = _profile(spark, sf_dir).withColumns({"has_files": F.col("files") > 0, "has_bytes": F.col("bytes") > 0})
    return profile.drop("files", "bytes")


@register("join_inventory", f"""
WITH p AS ({PROFILE_SQL}),
j AS (SELECT unnest(['orders_customer', 'orders_events', 'lineitem_part']) AS join_name,
        unnest(['orders', 'orders', 'lineitem']) AS left_table, unnest(['customer', 'events', 'part']) AS right_table)
SELECT join_name, left_table, right_table, l.rows AS left_rows, l.distinct_keys AS left_keys, r.rows AS right_rows,
       r.distinct_keys AS right_keys, CASE WHEN l.rows < r.rows THEN left_table ELSE right_table END AS smaller_side
FROM j JOIN p l ON left_table = l.table_name JOIN p r ON right_table = r.table_name
""")
def join_inventory(spark, sf_dir):
    joins = [("orders_customer", "orders", "customer"), ("orders_events", "orders", "events"),
             ("lineitem_part", "lineitem", "part")]
    return quality.join_inventory(_profile(spark, sf_dir), joins)


# --- run against run --------------------------------------------------------

def _flags(lines, value):
    return lines.groupBy("l_returnflag", "l_linestatus").agg(F.sum(value.cast("bigint")).alias("value")).select(
        F.col("l_returnflag").alias("section"), F.col("l_linestatus").alias("name"), "value"
    )


@register("run_compare", """
WITH b AS (SELECT l_returnflag AS section, l_linestatus AS name, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS v
           FROM lineitem GROUP BY ALL),
a AS (SELECT l_returnflag AS section, l_linestatus AS name, CAST(sum(CAST(l_linenumber AS BIGINT)) AS BIGINT) AS v
      FROM lineitem WHERE l_linestatus = 'F' GROUP BY ALL)
SELECT section, name, b.v AS before, a.v AS after, a.v - b.v AS change,
       CAST(a.v - b.v AS DOUBLE) * 100.0 / nullif(CAST(b.v AS DOUBLE), 0) AS percent
FROM b FULL JOIN a USING (section, name)
""")
def run_compare(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    after = _flags(lines.filter("l_linestatus = 'F'"), F.col("l_linenumber"))
    return quality.compare_runs(_flags(lines, F.col("l_quantity")), after)


@register("run_diff", f"""
WITH {RAW_IMPRESSIONS},
b AS (SELECT bid_request_id, count(*) AS feedback FROM raw_impressions WHERE feedback_type = 'same_hour' GROUP BY 1),
a AS (SELECT bid_request_id, count(*) AS feedback FROM raw_impressions GROUP BY 1)
SELECT *, 'only_before' AS side, CAST(1 AS BIGINT) AS copies FROM (SELECT * FROM b EXCEPT SELECT * FROM a)
UNION ALL SELECT *, 'only_after', 1 FROM (SELECT * FROM a EXCEPT SELECT * FROM b)
""")
def run_diff(spark, sf_dir):
    """Feedback per bid without and with the late hour."""
    def counted(df):
        return df.groupBy("bid_request_id").agg(F.count(F.lit(1)).alias("feedback"))

    same, late = (roles.impressions(spark, sf_dir, late=late) for late in (False, True))
    return quality.run_diff(counted(same), counted(same.unionByName(late)))


# --- task diagnosis: events as task metrics ---------------------------------

def _tasks(spark, sf_dir):
    """Stage = event type; whole-millisecond run time from the value; GC share from the payload."""
    millis = F.floor(F.col("value") * 1000 + 0.5)
    gc = F.floor(millis * F.get_json_object("props", "$.k").cast("int") / 100)
    return table(spark, sf_dir, "events").select(
        "event_type", millis.alias("run_ms"), gc.alias("gc_ms")
    )


TASKS = """
tasks AS (SELECT event_type AS stage, CAST(floor(value * 1000 + 0.5) AS BIGINT) AS run_ms,
  CAST(floor(floor(value * 1000 + 0.5) * CAST(props->>'$.k' AS INTEGER) / 100) AS BIGINT) AS gc_ms FROM events)"""


@register("task_skew_class", f"""
WITH {TASKS}, s AS (SELECT stage, count(*) AS tasks, quantile_cont(CAST(run_ms AS DOUBLE), 0.5) AS median_ms,
  max(run_ms) AS max_ms FROM tasks GROUP BY stage)
SELECT *, max_ms / median_ms AS ratio, CASE WHEN max_ms / median_ms >= 5 THEN 'likely'
  WHEN max_ms / median_ms >= 3 THEN 'watch' ELSE 'ok' END AS skew_class
FROM s
""")
def task_skew_class(spark, sf_dir):
    return quality.task_skew(_tasks(spark, sf_dir), "event_type", "run_ms")


@register("gc_class", f"""
WITH {TASKS}, s AS (SELECT stage, CAST(sum(run_ms) AS BIGINT) AS run_ms, CAST(sum(gc_ms) AS BIGINT) AS gc_ms
  FROM tasks GROUP BY stage)
SELECT *, CAST(gc_ms AS DOUBLE) / CAST(run_ms AS DOUBLE) AS gc_share,
  CASE WHEN gc_share >= 0.5 THEN 'severe' WHEN gc_share >= 0.2 THEN 'pressure' WHEN gc_share >= 0.1 THEN 'watch'
       ELSE 'ok' END AS gc_class
FROM s
""")
def gc_class(spark, sf_dir):
    return quality.gc_pressure(_tasks(spark, sf_dir), "event_type", "run_ms", "gc_ms")


@register("task_waves", f"""
WITH {TASKS}, s AS (SELECT stage, count(*) AS tasks, quantile_cont(CAST(run_ms AS DOUBLE), 0.5) AS median_ms
  FROM tasks GROUP BY stage)
SELECT *, CAST(ceil(tasks / 12.0) AS BIGINT) AS waves, ceil(tasks / 12.0) * median_ms AS expected_ms FROM s
""")
def task_waves(spark, sf_dir):
    return quality.task_waves(_tasks(spark, sf_dir), "event_type", "run_ms", slots=12)
