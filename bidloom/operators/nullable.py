"""Left joins on nullable columns, in which null matches null.

Such columns are often null together, so one key may hold most of the rows: every form splits hot keys by `spread_by`.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bidloom.functions.scalars import surrogate_key
from bidloom.operators import skew

Pairs = Sequence[tuple[str, str]]


def null_safe_left(left: DataFrame, right: DataFrame, pairs: Pairs, spread_by: Sequence[str], **limits) -> DataFrame:
    """Comparison column by column."""
    hot = skew.find(left, {"key": [a for a, _ in pairs]}, **limits)
    return skew.left_join(left, right, pairs, hot["key"], spread_by, null_safe=True)


def surrogate_left(left: DataFrame, right: DataFrame, pairs: Pairs, spread_by: Sequence[str], **limits) -> DataFrame:
    """One hashed key, which keeps a wide nullable key out of the shuffle and the comparison."""
    keyed_left = left.withColumn("_sk", surrogate_key(*[a for a, _ in pairs]))
    keyed_right = right.withColumn("_sk_r", surrogate_key(*[b for _, b in pairs]))
    hot = skew.find(keyed_left, {"key": ["_sk"]}, **limits)
    return skew.left_join(keyed_left, keyed_right, [("_sk", "_sk_r")], hot["key"], spread_by).drop("_sk", "_sk_r")


def split_null_left(left: DataFrame, right: DataFrame, pairs: Pairs, spread_by: Sequence[str], **limits) -> DataFrame:
    """Two paths: plain equality for complete keys, null-safe for the rest."""
    def complete(names: Sequence[str]) -> Column:
        return reduce(Column.__and__, [F.col(n).isNotNull() for n in names])

    left_full, right_full = complete([a for a, _ in pairs]), complete([b for _, b in pairs])
    hot = skew.find(left, {"key": [a for a, _ in pairs]}, **limits)["key"]
    plain = skew.left_join(left.filter(left_full), right.filter(right_full), pairs, hot, spread_by)
    rest = skew.left_join(left.filter(~left_full), right.filter(~right_full), pairs, hot, spread_by, null_safe=True)
    return plain.unionByName(rest)
