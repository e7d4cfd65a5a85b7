"""Time-bounded matches without forming the pairs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from bidloom.operators import skew


SECOND = 1_000_000


def count_within(
    left: DataFrame,
    right: DataFrame,
    keys: list[str],
    left_time: str,
    right_time: str,
    seconds: int,
    spread_by: Sequence[str],
    **limits,
) -> DataFrame:
    """Per left row, how many right rows share its keys and lie in [t - seconds, t]; times in whole microseconds.

    The pairs are never formed. The whole seconds between the bounds are counted from one row per key and second, in
    time buckets of `seconds` (each right second is placed in its own bucket and the next, and a range frame adds up).
    The two seconds that the bounds cut are counted by running sums within that second. So a hot key spreads over its
    buckets and seconds.
    """
    second, fraction = F.floor(F.col("_t") / SECOND), F.pmod(F.col("_t"), F.lit(SECOND))
    right_micros = (
        right.select(*keys, F.col(right_time).cast("bigint").alias("_t"))
        .groupBy(*keys, "_t").agg(F.count(F.lit(1)).alias("_n"))
        .select(*keys, second.alias("_s"), fraction.alias("_f"), "_n")
    )
    probes = left.select(*keys, F.col(left_time).cast("bigint").alias("_t")).distinct().select(
        *keys, second.alias("_s"), fraction.alias("_f"))

    # The seconds strictly between the two that the bounds cut.
    bucket = F.floor(F.col("_s") / F.lit(seconds))
    per_second = right_micros.groupBy(*keys, "_s").agg(F.sum("_n").alias("_n"))
    placed = per_second.select(
        *keys, "_s", "_n", F.explode(F.array(bucket, bucket + 1)).alias("_bucket"), F.lit(False).alias("_probe"))
    asked = probes.select(*keys, "_s").distinct().select(
        *keys, "_s", F.lit(0).cast("bigint").alias("_n"), bucket.alias("_bucket"), F.lit(True).alias("_probe"))
    inner = Window.partitionBy(*keys, "_bucket").orderBy("_s").rangeBetween(1 - seconds, -1)
    between = (
        placed.unionByName(asked).withColumn("_between", F.coalesce(F.sum("_n").over(inner), F.lit(0))).filter("_probe")
        .select(*[F.col(k).alias(f"_{k}") for k in keys], F.col("_s").alias("_at"), "_between")
    )
    # The cut seconds: up to the time in its own second, from the same fraction on in the second `seconds` earlier.
    none = F.lit(None).cast("bigint")
    cut = probes.select(*keys, "_f", F.col("_s").alias("_at"), F.explode(F.array(
        F.struct(F.col("_s").alias("s"), F.lit(True).alias("upper")),
        F.struct((F.col("_s") - seconds).alias("s"), F.lit(False).alias("upper")))).alias("_c"))
    cut = cut.select(*keys, F.col("_c.s").alias("_s"), "_f", F.lit(0).cast("bigint").alias("_n"), "_at",
                     F.col("_c.upper").alias("_upper"))
    known = right_micros.select(*keys, "_s", "_f", "_n", none.alias("_at"), F.lit(None).cast("boolean").alias("_upper"))
    inside = Window.partitionBy(*keys, "_s").orderBy("_f")
    until = F.sum("_n").over(inside.rangeBetween(Window.unboundedPreceding, 0))
    since = F.sum("_n").over(inside.rangeBetween(0, Window.unboundedFollowing))
    edges = known.unionByName(cut).withColumn("_edge", F.when(F.col("_upper"), until).otherwise(since))
    edges = edges.filter(F.col("_at").isNotNull()).groupBy(*keys, "_at", "_f").agg(F.sum("_edge").alias("_edges"))
    answered = edges.join(between, [edges[k].eqNullSafe(between[f"_{k}"]) for k in keys]
                          + [edges["_at"] == between["_at"]])
    answered = answered.select(
        *[F.col(f"_{k}") for k in keys], (edges["_at"] * SECOND + F.col("_f")).alias("_when"),
        (F.col("_edges") + F.col("_between")).alias("matches"))
    joined = _to_left(left, answered, keys, left_time, spread_by, limits)
    return joined.select(*left.columns, F.coalesce("matches", F.lit(0).cast("bigint")).alias("matches"))


def latest_within(
    left: DataFrame,
    right: DataFrame,
    keys: list[str],
    left_time: str,
    right_time: str,
    seconds: int,
    spread_by: Sequence[str],
    **limits,
) -> DataFrame:
    """Left rows with the columns of the latest right row that shares their keys and lies in [t - seconds, t].

    Times in whole microseconds. Of equal times the row with the largest other columns counts; without a match the
    columns are null. No pairs: each right row is placed in its time bucket and the next, and a running maximum
    answers every probe of the bucket. A hot key spreads over its buckets.
    """
    width = seconds * SECOND
    values = [c for c in right.columns if c not in (*keys, right_time)]
    row = F.struct(F.col(right_time).cast("bigint").alias("_t"), *values)
    latest = right.groupBy(*keys, F.col(right_time).cast("bigint").alias("_t")).agg(F.max(row).alias("_row"))
    bucket = F.floor(F.col("_t") / F.lit(width))
    placed = latest.select(*keys, "_t", "_row", F.explode(F.array(bucket, bucket + 1)).alias("_bucket"),
                           F.lit(False).alias("_probe"))
    probes = left.select(*keys, F.col(left_time).cast("bigint").alias("_t")).distinct()
    probes = probes.select(*keys, "_t", F.lit(None).cast(latest.schema["_row"].dataType).alias("_row"),
                           bucket.alias("_bucket"), F.lit(True).alias("_probe"))
    frame = Window.partitionBy(*keys, "_bucket").orderBy("_t").rangeBetween(Window.unboundedPreceding, 0)
    answered = placed.unionByName(probes).withColumn("_best", F.max("_row").over(frame)).filter("_probe")
    near = F.when(F.col("_best._t") >= F.col("_t") - width, F.col("_best"))
    answered = answered.select(*[F.col(k).alias(f"_{k}") for k in keys], F.col("_t").alias("_when"), near.alias("_best"))
    joined = _to_left(left, answered, keys, left_time, spread_by, limits)
    return joined.select(*left.columns, F.col("_best._t").alias(right_time), *[F.col(f"_best.{c}").alias(c) for c in values])


def _to_left(left: DataFrame, answered: DataFrame, keys: list[str], left_time: str, spread_by: Sequence[str],
             limits: dict) -> DataFrame:
    """One answer per key and time, so this join keeps the number of left rows."""
    timed = left.withColumn("_time", F.col(left_time).cast("bigint"))
    pairs = [(k, f"_{k}") for k in keys] + [("_time", "_when")]
    hot = skew.find(timed, {"key": [*keys, "_time"]}, **limits)
    return skew.left_join(timed, answered, pairs, hot["key"], spread_by)
