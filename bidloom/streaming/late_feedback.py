"""Streaming twins of the feedback join and of the five-minute buckets."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bidloom import fixed_values as fv


def tumbling_counts(events: DataFrame, ts: str, delay: str, minutes: int = fv.TIME_BUCKET_MINUTES) -> DataFrame:
    """Rows per time bucket. In append mode a bucket is emitted once, when the watermark has passed its end; in update
    mode whenever it has grown, so that a finished input leaves none out."""
    return (
        events.withWatermark(ts, delay)
        .groupBy(F.window(ts, f"{minutes} minutes").alias("bucket"))
        .agg(F.count(F.lit(1)).alias("rows"))
        .select(F.col("bucket.start").alias("bucket_start"), "rows")
    )


def join_feedback(bids: DataFrame, feedback: DataFrame, bound: str = "2 hours") -> DataFrame:
    """Each bid with one feedback within the bound, or with none once the bound has passed.

    State on both sides is dropped by the watermark, so it holds a few hours of data and not the whole stream.
    """
    left = bids.withWatermark("bid_timestamp", bound)
    right = (
        feedback.select(F.col("bid_request_id").alias("feedback_bid_id"), "impression_id", "feedback_timestamp",
                        "clearing_price", "feedback_type")
        .withWatermark("feedback_timestamp", bound)
        .dropDuplicatesWithinWatermark(["feedback_bid_id"])
    )
    near = (
        (F.col("bid_request_id") == F.col("feedback_bid_id"))
        & (F.col("feedback_timestamp") >= F.col("bid_timestamp"))
        & (F.col("feedback_timestamp") <= F.col("bid_timestamp") + F.expr(f"INTERVAL {bound}"))
    )
    return left.join(right, near, "leftOuter").drop("feedback_bid_id")


FEEDBACK = ("feedback_timestamp", "impression_id", "clearing_price", "feedback_type")


def latest_feedback(bids: DataFrame, feedback: DataFrame, bound: str, delay: str = "1 hour") -> DataFrame:
    """Each bid with its latest feedback within the bound, or with nulls where there is none: the batch job's survivor.

    Two stateful operators in append mode. A watermarked outer join finds the feedback of each bid; it emits a bid
    without any once its bound has passed. An aggregate by bid and its time then elects the latest one, ties broken by
    all other columns; a bid is emitted when no join can add to it any more. State is dropped by the watermark. Over batch inputs the same plan gives the same rows. A bid_request_id that is null has no
    feedback; of bids with one id and one time there is one row; a bid without a time is dropped, as it never ends.
    `run_available` emits what is final; `closing_rows` on both inputs, and another run, emit the rest.
    """
    left = bids.select("bid_request_id", "bid_timestamp").withWatermark("bid_timestamp", delay)
    right = feedback.select(F.col("bid_request_id").alias("feedback_bid_id"), *FEEDBACK).withWatermark(
        "feedback_timestamp", delay)
    near = (
        (F.col("bid_request_id") == F.col("feedback_bid_id"))
        & (F.col("feedback_timestamp") >= F.col("bid_timestamp"))
        & (F.col("feedback_timestamp") <= F.col("bid_timestamp") + F.expr(f"INTERVAL {bound}"))
    )
    # Not a bid without feedback but a struct of nulls: max() over it is that struct again.
    elected = F.max(F.struct(*FEEDBACK)).alias("_latest")
    joined = left.join(right, near, "leftOuter")
    return joined.groupBy("bid_request_id", "bid_timestamp").agg(elected).select("bid_request_id", "bid_timestamp", "_latest.*")


def closing_rows(like: DataFrame, time: str, at: str, key: str, value) -> DataFrame:
    """One row with a time so far ahead that the watermark passes all others, and nulls besides.

    `value` is a key that no row has; a null would be filtered before the watermark sees the row.
    """
    row, fixed = like.sparkSession.range(1), {time: at, key: value}
    values = {f.name: F.lit(fixed.get(f.name)).cast(f.dataType) for f in like.schema.fields}
    return row.select(*[value.alias(name) for name, value in values.items()])


def run_available(stream: DataFrame, target: str, checkpoint: str) -> None:
    """Process what has arrived, append it as Parquet, stop."""
    query = (
        stream.writeStream.format("parquet").outputMode("append")
        .option("path", target).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )
    query.awaitTermination()


def run_updates(stream: DataFrame, target: str, checkpoint: str) -> None:
    """Process what has arrived in update mode; every batch's changed rows are appended with the batch's number."""
    def keep(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{target}/batch={number}")

    query = (
        stream.writeStream.outputMode("update").foreachBatch(keep).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )
    query.awaitTermination()


def latest_updates(written: DataFrame, keys: list[str]) -> DataFrame:
    """The last state of each key from what `run_updates` has written."""
    values = [c for c in written.columns if c not in (*keys, "batch")]
    last = F.max_by(F.struct(*values), F.col("batch").cast("bigint")).alias("_last")
    return written.groupBy(*keys).agg(last).select(*keys, "_last.*")
