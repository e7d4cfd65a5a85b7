"""Size of a many-to-many join without running it, and the weights that replace it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bidloom.operators import quantiles
from bidloom.session import materialize

# Product of two row counts: a hot key on both sides passes the range of a long.
_WIDE = "decimal(19,0)"


def key_counts(df: DataFrame, keys: list[str], name: str, names: list[str] | None = None) -> DataFrame:
    """Rows per key, with the keys optionally renamed."""
    renamed = [F.col(k).alias(n) for k, n in zip(keys, names or keys)]
    return df.groupBy(*renamed).agg(F.count(F.lit(1)).alias(name))


SHARES = {"p50": 0.50, "p75": 0.75, "p95": 0.95}


def _with_spread(sizes: DataFrame, values: DataFrame, value: str, copies: str) -> DataFrame:
    """Adds the exact p50/p75/p95 of a value that occurs `copies` times; null values are skipped."""
    found = quantiles.exact_quantiles(values, value, copies, list(SHARES.values()))
    return sizes.withColumns({name: F.lit(q).cast("double") for name, q in zip(SHARES, found)})


def value_profile(df: DataFrame, value: str) -> DataFrame:
    """Count, sum, mean, p50/p75/p95 and maximum of a whole-number column, from one row per distinct value."""
    histogram = materialize(df.groupBy(F.col(value).alias("_v")).agg(F.count(F.lit(1)).alias("_n")), "value_counts")
    total = F.sum(F.col("_v").cast(_WIDE) * F.col("_n").cast(_WIDE))
    profile = histogram.agg(F.sum("_n").alias("keys"), total.alias("rows"), F.max(F.col("_v").cast("decimal(38,0)")).alias("max"))
    mean = F.col("rows").cast("double") / F.col("keys").cast("double")
    return _with_spread(profile, histogram, "_v", "_n").select("keys", "rows", mean.alias("avg"), *SHARES, "max")


def rows_per_key(left: DataFrame, right: DataFrame, left_keys: list[str], right_keys: list[str]) -> DataFrame:
    """Per left key: rows on both sides and rows a left join would give; null keys match nothing."""
    on = [f"key_{i}" for i in range(len(left_keys))]
    per_left = key_counts(left, left_keys, "left_rows", on)
    per_right = key_counts(right.dropna(subset=right_keys), right_keys, "right_rows", on)
    both = per_left.join(per_right, on, "left")
    multiplier = F.coalesce("right_rows", F.lit(1)).cast(_WIDE)
    return both.withColumn("join_rows", F.col("left_rows").cast(_WIDE) * multiplier)


def estimate(left: DataFrame, right: DataFrame, left_keys: list[str], right_keys: list[str]) -> DataFrame:
    """Exact sizes of the left and of the inner join, and the spread of joined rows over the matching keys.

    From one row per distinct product, of which no task holds all: sums, and quantiles by distributed selection.
    """
    per_key = rows_per_key(left, right, left_keys, right_keys)
    histogram = materialize(per_key.groupBy(F.col("right_rows").isNotNull().alias("_matched"), "join_rows").agg(
        F.count(F.lit(1)).alias("_n"), F.sum("left_rows").alias("_left")
    ), "join_sizes")
    matched_rows = F.when(F.col("_matched"), F.col("join_rows"))
    copies = F.col("_n").cast(_WIDE)
    none = F.lit(0).cast("decimal(38,0)")
    sizes = histogram.agg(
        F.sum("_left").alias("left_rows"),
        F.sum(F.when(F.col("_matched"), F.col("_n")).otherwise(F.lit(0))).alias("matching_keys"),
        F.coalesce(F.sum(matched_rows.cast("decimal(38,0)") * copies), none).alias("inner_rows"),
        F.sum(F.col("join_rows") * copies).alias("left_join_rows"),
        F.max(matched_rows.cast("decimal(38,0)")).alias("max"),
    )
    sizes = _with_spread(sizes, histogram.filter("_matched"), "join_rows", "_n")
    mean = F.col("inner_rows").cast("double") / F.nullif(F.col("matching_keys").cast("double"), F.lit(0.0))
    first = [c for c in sizes.columns if c not in (*SHARES, "max")]
    return sizes.select(*first, *SHARES, "max", mean.alias("avg"))


def largest_keys(
    left: DataFrame, right: DataFrame, left_keys: list[str], right_keys: list[str], n: int = 20
) -> DataFrame:
    """The n keys with most joined rows; ties by key."""
    per_key = rows_per_key(left, right, left_keys, right_keys).filter("right_rows IS NOT NULL")
    on = [c for c in per_key.columns if c.startswith("key_")]
    return per_key.orderBy(F.desc("join_rows"), *on).limit(n)


def key_weights(right: DataFrame, keys: list[str], counted: str, rows: str, events: str) -> DataFrame:
    """One row per complete key: how many rows a join would multiply by, and how many have `counted` set."""
    complete = right.dropna(subset=keys)
    return complete.groupBy(*keys).agg(
        F.count(F.lit(1)).alias(rows), F.count(counted).alias(events)
    )
