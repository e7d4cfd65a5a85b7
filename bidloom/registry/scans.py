"""Registered scans, sinks and scalar functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from bidloom.functions import scalars as s
from bidloom.functions.fixed_point import money_sum_sql
from bidloom.operators import sketches
from bidloom.plans import ingest, revenue
from bidloom.registry import roles
from bidloom.registry.base import register, table
from bidloom.session import sql_variables, work_folder
from bidloom.sources import files, sinks


@register("scan_glob", """
SELECT l_returnflag, l_linestatus, count(*) AS rows, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS quantity
FROM lineitem GROUP BY ALL
""")
def scan_glob(spark, sf_dir):
    lines = files.scan_glob(spark, sf_dir, "lineitem*", "parquet")
    return lines.groupBy("l_returnflag", "l_linestatus").agg(
        F.count(F.lit(1)).alias("rows"), F.sum(F.col("l_quantity").cast("bigint")).alias("quantity")
    )


def _dated_events(spark, sf_dir):
    """Events as a raw table with zero-padded string partitions."""
    parts = {"year": "yyyy", "month": "MM", "day": "dd"}
    events = table(spark, sf_dir, "events").withColumns({n: F.date_format("ts", f) for n, f in parts.items()})
    path = files.table_path(work_folder(spark, "raw"), "raw", "events")
    sinks.write_dated(events, path, list(parts))
    return path


@register("scan_partition", """
SELECT strftime(ts, '%Y') AS year, strftime(ts, '%m') AS month, strftime(ts, '%d') AS day, count(*) AS rows,
       CAST(sum(event_id) AS BIGINT) AS id_sum
FROM events GROUP BY 1, 2, 3
""")
def scan_partition(spark, sf_dir):
    events = files.scan_partitions(spark, _dated_events(spark, sf_dir), hourly=False)
    return events.groupBy("year", "month", "day").agg(
        F.count(F.lit(1)).alias("rows"), F.sum("event_id").alias("id_sum")
    )


# --- activity ingest --------------------------------------------------------

ACTIVITY_SCHEMA = "id bigint, created_at string, type string, repo struct<id:bigint,weight:int>"


def _landing(spark, sf_dir):
    """Events as gzip JSON activity files with a nested repo, several tasks writing."""
    created = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'")
    repo = F.struct(F.col("user_id").alias("id"), F.get_json_object("props", "$.k").cast("int").alias("weight"))
    activity = table(spark, sf_dir, "events").select(
        F.col("event_id").alias("id"), created.alias("created_at"), F.col("event_type").alias("type"),
        repo.alias("repo"),
    )
    path = work_folder(spark, "landing")
    activity.write.option("compression", "gzip").json(path)
    return path


def _ingested(spark, sf_dir):
    landing, target = _landing(spark, sf_dir), work_folder(spark, "activity")
    ingest.ingest(spark, landing, "part", target, schema=ACTIVITY_SCHEMA)
    return landing, target


@register("ingest_partitioned", """
SELECT CAST(year(ts) AS INTEGER) AS year, CAST(month(ts) AS INTEGER) AS month,
       CAST(day(ts) AS INTEGER) AS dayofmonth, count(*) AS rows,
       CAST(sum(user_id) AS BIGINT) AS repo_ids, CAST(sum(CAST(props->>'$.k' AS INTEGER)) AS BIGINT) AS weights
FROM events GROUP BY 1, 2, 3
""")
def ingest_partitioned(spark, sf_dir):
    _, target = _ingested(spark, sf_dir)
    return spark.read.parquet(target).groupBy("year", "month", "dayofmonth").agg(
        F.count(F.lit(1)).alias("rows"), F.sum("repo.id").alias("repo_ids"), F.sum("repo.weight").alias("weights")
    )


@register("reconcile_counts", """
SELECT CAST(year(ts) AS INTEGER) AS year, CAST(month(ts) AS INTEGER) AS month,
       CAST(day(ts) AS INTEGER) AS dayofmonth, count(*) AS source_rows, count(*) AS target_rows,
       CAST(0 AS BIGINT) AS difference
FROM events GROUP BY 1, 2, 3
""")
def reconcile_counts(spark, sf_dir):
    landing, target = _ingested(spark, sf_dir)
    source = ingest.with_date_parts(files.scan_glob(spark, landing, "part-*", "json", ACTIVITY_SCHEMA))
    return sinks.reconcile_counts(source, spark.read.parquet(target), ingest.DATE_KEYS)


@register("daily_counts", "SELECT CAST(ts AS DATE) AS created_at, count(*) AS rows FROM events GROUP BY 1")
def daily_counts(spark, sf_dir):
    return ingest.daily_counts(table(spark, sf_dir, "events"), "ts")


@register("date_parts", """
SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS year, CAST(month(o_orderdate) AS INTEGER) AS month,
       CAST(day(o_orderdate) AS INTEGER) AS dayofmonth
FROM orders
""")
def date_parts(spark, sf_dir):
    return table(spark, sf_dir, "orders").select("o_orderkey", *[
        c.alias(n) for n, c in s.date_parts("o_orderdate").items()
    ])


@register("struct_expand", "SELECT event_id, CAST(props->>'$.k' AS INTEGER) AS k FROM events")
def struct_expand(spark, sf_dir):
    return ingest.expand_json(table(spark, sf_dir, "events"), "props", "struct<k:int>", "event_id")


# --- snapshots and layout ---------------------------------------------------

@register("write_roundtrip", "SELECT * FROM orders")
def write_roundtrip(spark, sf_dir):
    path = work_folder(spark, "snapshot")
    orders = table(spark, sf_dir, "orders")
    sinks.write_snapshot(orders, path)
    return spark.read.schema(orders.schema).parquet(path)


@register("codec_compare", """
SELECT unnest(['snappy', 'gzip', 'zstd']) AS codec, (SELECT count(*) FROM lineitem) AS rows, true AS has_bytes
""")
def codec_compare(spark, sf_dir):
    """Rows read back from each codec's files; how many bytes these take is the operator's, not a matter of SQL."""
    report = sinks.compare_codecs(table(spark, sf_dir, "lineitem"), work_folder(spark, "codecs"))
    return report.select("codec", "rows", (F.col("bytes") > 0).alias("has_bytes"))


@register("clustered_write", """
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_shipdate FROM lineitem
""")
def clustered_write(spark, sf_dir):
    path = work_folder(spark, "clustered")
    sinks.write_clustered(table(spark, sf_dir, "lineitem"), path, ["l_shipdate", "l_suppkey"])
    return spark.read.parquet(path).select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_shipdate"
    )


INVENTORY_KEYS = {
    "region": "r_regionkey", "nation": "n_nationkey", "customer": "c_custkey", "supplier": "s_suppkey",
    "part": "p_partkey", "orders": "o_custkey", "lineitem": "l_orderkey", "events": "user_id", "documents": "doc_id",
    "embeddings": "vec_id", "pages": "page_id", "benchmark": "item_id", "labels": "doc_id",
    "conversations": "conv_id",
}


@register("table_inventory", " UNION ALL ".join(
    f"SELECT '{name}' AS table_name, count(*) AS rows, count(DISTINCT {key}) AS keys, true AS has_bytes FROM {name}"
    for name, key in INVENTORY_KEYS.items()))
def table_inventory(spark, sf_dir):
    """Rows and exact keys of every given table; the file count and bytes are the operator's, not a matter of SQL."""
    reports = None
    for name, key in INVENTORY_KEYS.items():
        df = table(spark, sf_dir, name)
        keys = df.select(key).where(F.col(key).isNotNull()).groupBy(key).count().agg(F.count(F.lit(1))).scalar()
        report = files.file_inventory(df).select(
            F.lit(name).alias("table_name"), "rows", keys.alias("keys"), (F.col("bytes") > 0).alias("has_bytes")
        )
        reports = report if reports is None else reports.unionByName(report)
    return reports


# --- scalar functions -------------------------------------------------------

@register("normalize_hash", f"""
WITH u AS (SELECT o_orderkey, {roles._sql_user('o_custkey')} AS user_id, o_custkey FROM orders)
SELECT o_orderkey, lower(trim(user_id)) AS normalized, sha256(lower(trim(user_id))) AS user_hash,
       sha256(CAST(o_custkey AS VARCHAR)) AS key_hash
FROM u
""")
def normalize_hash(spark, sf_dir):
    normalized = s.normalize_id(roles.user_id("o_custkey"))
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", normalized.alias("normalized"), s.sha256_hex(normalized).alias("user_hash"),
        s.sha256_hex("o_custkey").alias("key_hash"),
    )


@register("stable_uuid", f"SELECT c_custkey, {roles._sql_uuid('c_name')} AS user_uuid FROM customer")
def stable_uuid(spark, sf_dir):
    return table(spark, sf_dir, "customer").select("c_custkey", s.stable_uuid("c_name").alias("user_uuid"))


@register("time_floor", f"SELECT event_id, {roles.sql_floor('ts')} AS bucket FROM events")
def time_floor(spark, sf_dir):
    return table(spark, sf_dir, "events").select(
        "event_id", s.floor_minutes("ts", 5).cast("timestamp_ntz").alias("bucket")
    )


@register("composite_keys", """
SELECT l_orderkey, l_partkey, concat_ws(':', l_orderkey, l_suppkey) AS order_supplier,
       concat_ws('#', l_partkey, CASE WHEN l_returnflag <> 'N' THEN l_returnflag END) AS part_flag
FROM lineitem
""")
def composite_keys(spark, sf_dir):
    returned = F.when(F.col("l_returnflag") != "N", F.col("l_returnflag"))
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", s.composite_key("l_orderkey", "l_suppkey").alias("order_supplier"),
        s.composite_key("l_partkey", returned, sep="#").alias("part_flag"),
    )


@register("bucketize", """
SELECT l_orderkey, l_partkey, l_linenumber,
       CASE WHEN price >= 4.0 THEN 'premium' WHEN price >= 2.0 THEN 'standard' ELSE 'low' END AS price_bucket,
       CASE WHEN l_returnflag = 'R' THEN 0.1 WHEN price >= 4.0 THEN 0.95 ELSE 0.7 END::DOUBLE AS quality,
       CASE WHEN share >= 0.75 THEN 'very_high' WHEN share >= 0.5 THEN 'high' WHEN share >= 0.25 THEN 'medium'
            ELSE 'low' END AS share_band,
       CASE WHEN percent >= 75 THEN 'very_high' WHEN percent >= 50 THEN 'high' WHEN percent >= 25 THEN 'medium'
            ELSE 'low' END AS percent_band,
       CASE WHEN l_linestatus = 'F' THEN 1 ELSE 0 END AS finished
FROM (SELECT *, l_extendedprice / 10000.0 AS price, l_quantity / 50.0 AS share, l_quantity * 2 AS percent
      FROM lineitem)
""")
def bucketize(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").withColumns({
        "price": F.col("l_extendedprice") / 10000.0, "share": F.col("l_quantity") / 50.0,
        "percent": F.col("l_quantity") * 2, "is_test": F.col("l_returnflag") == "R",
    })
    return lines.select(
        "l_orderkey", "l_partkey", "l_linenumber", s.price_bucket("price").alias("price_bucket"),
        s.quality_score("is_test", "price").alias("quality"), s.unit_score_band("share").alias("share_band"),
        s.percent_score_band("percent").alias("percent_band"),
        s.flag(F.col("l_linestatus") == "F").alias("finished"),
    )


@register("salt_spread", f"""
WITH {roles.sql_murmur_salts('lineitem', 'l_orderkey')}
SELECT salt, count(*) AS rows, count(DISTINCT l_orderkey) AS keys FROM lineitem JOIN salts USING (l_orderkey)
GROUP BY salt
""")
def salt_spread(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", s.murmur_salt("l_orderkey").alias("salt"))
    return lines.groupBy("salt").agg(F.count(F.lit(1)).alias("rows"), F.count_distinct("l_orderkey").alias("keys"))


@register("salt_spread_portable", """
SELECT CAST(CAST('0x' || substr(md5(CAST(l_orderkey AS VARCHAR)), 1, 8) AS BIGINT) % 16 AS INTEGER) AS salt,
       count(*) AS rows
FROM lineitem GROUP BY 1
""")
def salt_spread_portable(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select(s.portable_salt("l_orderkey").alias("salt"))
    return lines.groupBy("salt").agg(F.count(F.lit(1)).alias("rows"))


# --- sketches ---------------------------------------------------------------

@register("register_merge", """
SELECT label, string_agg(CAST(value AS VARCHAR), ',' ORDER BY pos) AS registers FROM (
  SELECT label, pos, max(CAST(floor(embedding[pos] * 1000) AS BIGINT)) AS value
  FROM (SELECT label, embedding, unnest(generate_series(1, len(embedding))) AS pos FROM embeddings)
  GROUP BY label, pos) GROUP BY label
""")
def register_merge(spark, sf_dir):
    registers = F.transform("embedding", lambda x: F.floor(x * F.lit(1000).cast("float")))
    sketched = table(spark, sf_dir, "embeddings").select("label", registers.alias("registers"))
    merged = sketches.merge_registers(sketched, "label", "registers")
    return merged.select("label", F.array_join(F.col("registers").cast("array<string>"), ",").alias("registers"))


@register("distinct_sketch", """
SELECT event_type, count(DISTINCT user_id) AS users, true AS within_error FROM events GROUP BY event_type
""")
def distinct_sketch(spark, sf_dir):
    """Exact distinct users beside the merged sketch: within five standard errors, 1.04 / sqrt(registers) each."""
    events = table(spark, sf_dir, "events")
    daily = sketches.distinct_sketches(events.withColumn("day", F.to_date("ts")), ["day", "event_type"], "user_id")
    merged = sketches.merge_sketches(daily, ["event_type"])
    exact = events.groupBy("event_type").agg(F.count_distinct("user_id").alias("users"))
    return _beside(exact.join(merged, "event_type"), "users", "distinct_estimate", 5 * 1.04 / 2**6).drop("distinct_estimate")


def _beside(df, exact, estimate, error):
    return df.withColumn("within_error", F.abs(F.col(estimate) - F.col(exact)) <= F.ceil(F.col(exact) * error))


@register("approx_keys", """
SELECT unnest(['l_orderkey', 'l_partkey']) AS key, unnest([count(DISTINCT l_orderkey), count(DISTINCT l_partkey)]) AS keys,
       true AS within_error
FROM lineitem
""")
def approx_keys(spark, sf_dir):
    """Exact distinct keys beside the approximate count: within five of its standard errors of 5 %."""
    lines = table(spark, sf_dir, "lineitem")

    def one(key):
        exact = lines.groupBy(key).count().agg(F.count(F.lit(1)).alias("keys"))
        both = exact.withColumn("estimate", lines.agg(F.approx_count_distinct(key)).scalar())
        return _beside(both, "keys", "estimate", 0.25).select(F.lit(key).alias("key"), "keys", "within_error")

    return one("l_orderkey").unionByName(one("l_partkey"))


# --- templated SQL ----------------------------------------------------------

@register("daily_revenue_param", f"""
SELECT CAST(o_orderdate AS DATE) AS order_date, o_orderstatus AS order_status, l_partkey AS product_id,
       {roles.sql_money('l_extendedprice * (1 - l_discount)')} AS revenue
FROM orders JOIN lineitem ON l_orderkey = o_orderkey GROUP BY ALL
""")
def daily_revenue_param(spark, sf_dir):
    with sql_variables(spark, {"data.dir": sf_dir.rstrip("/")}):
        for name in ("orders", "lineitem"):
            spark.sql(
                f"CREATE OR REPLACE TEMPORARY VIEW param_{name} USING PARQUET "
                f"OPTIONS (path='${{data.dir}}/{name}.parquet')"
            )
        return spark.sql(f"""
            SELECT CAST(o.o_orderdate AS DATE) AS order_date, o.o_orderstatus AS order_status,
                   i.l_partkey AS product_id,
                   {money_sum_sql('i.l_extendedprice * (1 - i.l_discount)')} AS revenue
            FROM param_orders o JOIN param_lineitem i ON o.o_orderkey = i.l_orderkey
            GROUP BY ALL ORDER BY order_date, revenue DESC, order_status, product_id
        """)


@register("revenue_script", f"""
SELECT strftime(o_orderdate, '%Y-%m-%d') AS day, o_orderstatus AS status, l_partkey AS product,
       {roles.sql_money('l_extendedprice * (1 - l_discount)')} AS revenue
FROM orders JOIN lineitem ON l_orderkey = o_orderkey GROUP BY ALL
""")
def revenue_script(spark, sf_dir):
    """Both tables as JSON folders, the script over views of them, and its output directory read back."""
    landing, out = work_folder(spark, "retail"), work_folder(spark, "retail-out")
    table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("id"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("day"),
        F.col("o_orderstatus").alias("status")).write.json(f"{landing}/orders")
    table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("order_id"), F.col("l_partkey").alias("product"),
        (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("subtotal")).write.json(f"{landing}/order_items")
    revenue.script_from_json(spark, f"""
        SELECT day, status, product, {money_sum_sql('subtotal')} AS revenue
        FROM order_items JOIN orders ON id = order_id GROUP BY day, status, product
    """, {"retail.in": landing, "retail.out": out}, database="bidloom_retail")
    return spark.read.schema("day string, status string, product bigint, revenue double").json(out)


@register("late_hour_scan", """
SELECT strftime(ts, '%H') AS hour, count(*) AS rows, CAST(sum(event_id) AS BIGINT) AS id_sum FROM events
WHERE CAST(ts AS DATE) = (SELECT max(CAST(ts AS DATE)) FROM events) AND hour(ts) IN (10, 11) GROUP BY 1
""")
def late_hour_scan(spark, sf_dir):
    """A regular hour of the last day and the late hour after it: only these two folders are listed and read."""
    parts = {"year": "yyyy", "month": "MM", "day": "dd", "hour": "HH"}
    events = table(spark, sf_dir, "events").withColumns({n: F.date_format("ts", f) for n, f in parts.items()})
    path = files.table_path(work_folder(spark, "raw"), "raw", "hourly_events")
    sinks.write_dated(events, path, list(parts))
    last = table(spark, sf_dir, "events").agg(F.date_format(F.max("ts"), "yyyy-MM-dd")).first()[0]
    read = files.scan_partitions(spark, path, last, ("10", "11"))
    return read.groupBy("hour").agg(F.count(F.lit(1)).alias("rows"), F.sum("event_id").alias("id_sum"))
