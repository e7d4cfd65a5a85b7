"""Ways to join a many-rows-per-key side without multiplying the left rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bidloom.operators import skew
from bidloom.operators.dedup import keep_extreme

Pairs = Sequence[tuple[str, str]]


def _join_reduced(left: DataFrame, reduced: DataFrame, pairs: Pairs, spread_by: Sequence[str], **limits) -> DataFrame:
    hot = skew.find(left, {"key": [a for a, _ in pairs]}, **limits)
    return skew.left_join(left, reduced, pairs, hot["key"], spread_by)


def join_latest(
    left: DataFrame, right: DataFrame, pairs: Pairs, order: Sequence[str], spread_by: Sequence[str], **limits
) -> DataFrame:
    """Each left row with the latest right row of its key; `spread_by` tells the rows of a hot left key apart."""
    keys = [b for _, b in pairs]
    latest = keep_extreme(right.dropna(subset=keys), keys, list(order))
    return _join_reduced(left, latest, pairs, spread_by, **limits)


def join_summary(
    left: DataFrame, right: DataFrame, pairs: Pairs, summary: Sequence[Column], spread_by: Sequence[str], **limits
) -> DataFrame:
    """Each left row with aggregates of the right rows of its key."""
    keys = [b for _, b in pairs]
    reduced = right.dropna(subset=keys).groupBy(*keys).agg(*summary)
    return _join_reduced(left, reduced, pairs, spread_by, **limits)


def only_named(right: DataFrame, column: str, names: list[str]) -> DataFrame:
    return right.filter(F.col(column).isin(names))
