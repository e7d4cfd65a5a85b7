"""Merging register sketches, and Spark's own mergeable distinct sketch."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def merge_registers(df: DataFrame, key: str, registers: str) -> DataFrame:
    """Largest value per register position, per key; `registers` is an array of longs.

    Positions are reduced in the map tasks, so a shuffle carries at most one row per key, position and task, and
    the rebuilt array is as long as one sketch.
    """
    reduced = (
        df.select(key, F.posexplode(registers).alias("_pos", "_value"))
        .groupBy(key, "_pos").agg(F.max("_value").alias("_value"))
    )
    ordered = F.array_sort(F.collect_list(F.struct("_pos", "_value")))
    return reduced.groupBy(key).agg(F.transform(ordered, lambda r: r["_value"]).alias(registers))


def distinct_sketches(df: DataFrame, keys: list[str], value: str, lg_registers: int = 12) -> DataFrame:
    """One sketch of distinct values per key, storable and mergeable."""
    return df.groupBy(*keys).agg(F.hll_sketch_agg(value, lg_registers).alias("sketch"))


def merge_sketches(sketches: DataFrame, keys: list[str]) -> DataFrame:
    return sketches.groupBy(*keys).agg(F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("distinct_estimate"))
