"""One row per key."""

from __future__ import annotations

from collections.abc import Collection

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def keep_any(df: DataFrame, keys: list[str]) -> DataFrame:
    """An arbitrary row per key; use only where the rows of a key are interchangeable."""
    return df.dropDuplicates(keys)


def keep_extreme(
    df: DataFrame, keys: list[str], order: list[str], latest: bool = True, needed: Collection[str] | None = None
) -> DataFrame:
    """The row per key with the largest (or smallest) order columns.

    All other columns break ties, so the survivor is the same on every run. It is an aggregate, not a window:
    each map task reduces its rows first, and a key with most of the rows never gathers in one task.

    `needed` are the columns to return. Those that break ties after the last of them cannot change them and are not
    carried.
    """
    rest = [c for c in df.columns if c not in keys and c not in order]
    if needed is not None:
        while rest and rest[-1] not in needed:
            rest.pop()
        columns = [c for c in df.columns if c in needed]
    else:
        columns = df.columns
    picked = F.struct(*order, *rest)
    best = (F.max if latest else F.min)(picked).alias("_best")
    return df.groupBy(*keys).agg(best).select(*keys, "_best.*").select(*columns)
