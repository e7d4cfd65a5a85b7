"""Equi-joins with checked broadcasts."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BROADCAST_BYTES = 64 * 1024 * 1024
# Widths of Spark's in-memory rows: one 8-byte word per fixed-width column, plus the null bitmap and padding.
_WORD = 8


def _planned_bytes(df: DataFrame) -> int:
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def measured_bytes(df: DataFrame) -> int:
    """Size of the rows in memory, from one distributed pass over the data."""
    variable = [f.name for f in df.schema if isinstance(f.dataType, (T.StringType, T.BinaryType))]
    fixed = _WORD * (len(df.columns) + 2 + len(variable))
    lengths = [F.coalesce(F.octet_length(name), F.lit(0)) for name in variable]
    width = reduce(Column.__add__, lengths, F.lit(fixed).cast("bigint"))
    return df.agg(F.coalesce(F.sum(width), F.lit(0)).alias("bytes")).first()["bytes"]


def broadcast_if_small(df: DataFrame, limit: int = BROADCAST_BYTES) -> DataFrame:
    """Hint a broadcast only for a side whose size has been measured; otherwise leave the join to shuffle.

    The planner's file statistics rule out large sides without running anything. They count compressed bytes, so
    a side that passes is then measured. Nested columns have no cheap measure and are never hinted.
    """
    flat = not any(isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType)) for f in df.schema)
    if flat and _planned_bytes(df) <= limit and measured_bytes(df) <= limit:
        return F.broadcast(df)
    return df


def lookup(left: DataFrame, dimension: DataFrame, keys: list[str], limit: int = BROADCAST_BYTES) -> DataFrame:
    """Left join to a dimension on one or several keys, broadcast when it is small enough."""
    return left.join(broadcast_if_small(dimension, limit), keys, "left")


def equal_on(left: DataFrame, right: DataFrame, pairs: Sequence[tuple[str, str]], null_safe: bool = False) -> Column:
    def pair(a: Column, b: Column) -> Column:
        return a.eqNullSafe(b) if null_safe else a == b

    return reduce(Column.__and__, [pair(left[a], right[b]) for a, b in pairs])


def left_many(left: DataFrame, right: DataFrame, pairs: Sequence[tuple[str, str]]) -> DataFrame:
    """Many-to-many left join on differently named keys.

    Its size is the sum of products of the key counts: look at operators.fanout first.
    """
    return left.join(right, equal_on(left, right, pairs), "left")
