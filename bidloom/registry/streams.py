"""Registered streams: run over what is there, then read what they wrote."""

from __future__ import annotations

from pyspark.sql import functions as F

from bidloom.registry.base import register, table
from bidloom.session import work_folder
from bidloom.streaming import late_feedback


@register("stream_tumbling_counts", """
SELECT make_timestamp(CAST(floor(epoch(ts) / 300) * 300 AS BIGINT) * 1000000) AS bucket_start, count(*) AS rows
FROM events GROUP BY 1
""")
def stream_tumbling_counts(spark, sf_dir):
    """Every bucket of the input, the last, still open ones included."""
    schema = table(spark, sf_dir, "events").schema
    events = spark.readStream.schema(schema).parquet(f"{sf_dir.rstrip('/')}/events.parque[t]")
    target, state = work_folder(spark, "buckets"), work_folder(spark, "buckets-state")
    counted = late_feedback.tumbling_counts(events.withColumn("ts", F.col("ts").cast("timestamp")), "ts", "1 hour")
    late_feedback.run_updates(counted, target, state)
    written = late_feedback.latest_updates(spark.read.parquet(target), ["bucket_start"])
    return written.withColumn("bucket_start", F.col("bucket_start").cast("timestamp_ntz"))


@register("stream_latest_feedback", """
SELECT o_orderkey AS bid_request_id, o_orderdate AS bid_timestamp, l_shipdate AS feedback_timestamp, impression_id,
       clearing_price, feedback_type
FROM orders LEFT JOIN (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY o_orderkey ORDER BY l_shipdate DESC, impression_id DESC, clearing_price DESC,
                                 feedback_type DESC) AS place
    FROM (SELECT o_orderkey, l_shipdate, concat_ws('_', 'imp', l_orderkey, l_partkey, l_suppkey, l_linenumber) AS impression_id,
                 l_extendedprice * (1 - l_discount) / 10000.0 AS clearing_price,
                 CASE WHEN l_linestatus = 'O' THEN 'late_n_plus_1' ELSE 'same_hour' END AS feedback_type
          FROM lineitem JOIN orders ON l_orderkey = o_orderkey
          WHERE l_returnflag <> 'N' AND l_shipdate BETWEEN o_orderdate AND o_orderdate + INTERVAL 365 DAY))
  WHERE place = 1) USING (o_orderkey)
""")
def stream_latest_feedback(spark, sf_dir):
    """Orders as the stream of bids, accepted and returned lines as that of their feedback, to the end of both."""
    bids = _stream(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("bid_request_id"), F.col("o_orderdate").cast("timestamp").alias("bid_timestamp"))
    lines = _stream(spark, sf_dir, "lineitem").filter(F.col("l_returnflag") != "N")
    feedback = lines.select(
        F.concat_ws("_", F.lit("imp"), "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber").alias("impression_id"),
        F.col("l_orderkey").alias("bid_request_id"), F.col("l_shipdate").cast("timestamp").alias("feedback_timestamp"),
        (F.col("l_extendedprice") * (1 - F.col("l_discount")) / 10000.0).alias("clearing_price"),
        F.when(F.col("l_linestatus") == "O", "late_n_plus_1").otherwise("same_hour").alias("feedback_type"),
    )
    target, state = work_folder(spark, "feedback"), work_folder(spark, "feedback-state")
    ends = [(df, time, work_folder(spark, f"closing-{time}")) for df, time in (
        (bids, "bid_timestamp"), (feedback, "feedback_timestamp"))]

    def arrive(at: str | None) -> None:
        for df, time, folder in ends:
            rows = late_feedback.closing_rows(df, time, at or "1970-01-01", "bid_request_id", -1)
            (rows if at else rows.limit(0)).write.mode("append").parquet(folder)

    def run() -> None:
        both = [df.unionByName(spark.readStream.schema(df.schema).parquet(folder)) for df, _, folder in ends]
        late_feedback.run_available(late_feedback.latest_feedback(*both, bound="365 days"), target, state)

    arrive(None)
    run()
    # The first closing rows end the join's bounds, the second ones the windows of what the join gave then.
    for at in ("9000-01-01", "9500-01-01"):
        arrive(at)
        run()
    written = spark.read.parquet(target).filter("bid_timestamp < TIMESTAMP '9000-01-01'")
    return written.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("bid_timestamp", "feedback_timestamp")})


def _stream(spark, sf_dir, name):
    schema = table(spark, sf_dir, name).schema
    return spark.readStream.schema(schema).parquet(f"{sf_dir.rstrip('/')}/{name}.parque[t]")
