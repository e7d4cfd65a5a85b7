"""Salted aggregation and the merge that gives one row per key again."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bidloom import fixed_values as fv
from bidloom.functions.fixed_point import mean, present, quotient, weighted_units
from bidloom.functions.scalars import composite_key, murmur_salt

# Averages of the enrichment output and the column each is taken over.
AVERAGED = {
    "avg_bid_price": "bid_price",
    "avg_clearing_price": "clearing_price",
    "avg_quality_weighted_price": "quality_weighted_price",
    "avg_sib_score": "sib_score",
}
COUNTED = ("event_count", "bid_count", "impression_count", "eligible_user_count", "feature_event_count")


def with_salt(df: DataFrame, key: str, buckets: int = fv.SALT_BUCKETS, salt: Column | None = None) -> DataFrame:
    return df.withColumn("salt", murmur_salt(key, buckets) if salt is None else salt)


def salted_key(key: str) -> Column:
    return composite_key(key, "salt", sep="#")


def counts(weight: Column) -> list[Column]:
    """The five counters over rows that stand for `weight` joined rows each."""
    zero = F.lit(0).cast("bigint")
    return [
        F.sum(weight).alias("event_count"),
        F.count_distinct("bid_request_id").alias("bid_count"),
        F.sum(F.when(F.col("impression_id").isNotNull(), weight).otherwise(zero)).alias("impression_count"),
        F.sum(F.coalesce(F.col("eligible_user_flag"), F.lit(0)) * weight).alias("eligible_user_count"),
        F.sum("feature_events").alias("feature_event_count"),
    ]


def averages(weight: Column) -> list[Column]:
    return [mean(F.col(source), weight).alias(name) for name, source in AVERAGED.items()]


def salted_partials(
    rows: DataFrame, keys: list[str], weight: Column, salts: Sequence[str] = ("salt",), more: Sequence[Column] = ()
) -> DataFrame:
    """Per key and salts: counters, `more` of them too, and for each average its sum and its weight; all add up."""
    parts = []
    for name, source in AVERAGED.items():
        parts.append(weighted_units(F.col(source), weight).alias(f"{name}_sum"))
        parts.append(present(F.col(source), weight).alias(f"{name}_weight"))
    return rows.groupBy(*keys, *salts).agg(*counts(weight), *more, *parts)


def merge_salts(partials: DataFrame, keys: list[str], more: Sequence[str] = ()) -> DataFrame:
    """One row per key. Distinct bids add up because the salts are functions of the bid and of the key."""
    merged = [F.sum(name).alias(name) for name in (*COUNTED, *more)]
    for name in AVERAGED:
        merged.append(quotient(F.sum(f"{name}_sum"), F.sum(f"{name}_weight")).alias(name))
    return partials.groupBy(*keys).agg(*merged)
