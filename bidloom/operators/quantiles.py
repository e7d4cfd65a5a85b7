"""Exact quantiles of whole numbers by distributed selection.

A sorted copy, or all distinct values in one task, is not needed: values are counted in buckets of equal width between
their bounds, the buckets that hold the wanted ranks are cut into buckets again, until a bucket is one value. Each pass
is one aggregate of at most BUCKETS rows per wanted rank, whatever the number of values.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bidloom.session import materialize

BUCKETS = 1024
_WHOLE = "decimal(38,0)"


def _ranked(counted: DataFrame, ranks: Sequence[int], low: int, high: int, buckets: int) -> dict[int, int]:
    """The value at each rank (from 0) of `counted` (v, n), whose values lie between the bounds."""
    # Open ranges: (first value, last value) -> the ranks in it, less the rows before it.
    open_, found = {(low, high): {rank: rank for rank in ranks}}, {}
    while open_:
        number, place = F, F
        for i, (a, b) in enumerate(open_):
            inside = (F.col("v") >= F.lit(a).cast(_WHOLE)) & (F.col("v") <= F.lit(b).cast(_WHOLE))
            width = -(-(b - a + 1) // buckets)
            number = number.when(inside, F.lit(i))
            place = place.when(inside, F.call_function("div", F.col("v") - F.lit(a).cast(_WHOLE), F.lit(width).cast(_WHOLE)))
        sums = counted.select(number.alias("range"), place.alias("place"), "n").filter("range IS NOT NULL").groupBy(
            "range", "place").agg(F.sum("n").alias("n")).collect()
        sums = sorted((r["range"], r["place"], int(r["n"])) for r in sums)
        narrower: dict[tuple[int, int], dict[int, int]] = {}
        for i, ((a, b), wanted) in enumerate(open_.items()):
            width = -(-(b - a + 1) // buckets)
            for rank, left in wanted.items():
                for which, at, n in sums:
                    if which != i:
                        continue
                    if left < n:
                        first = a + at * width
                        if width == 1:
                            found[rank] = first
                        else:
                            narrower.setdefault((first, min(b, first + width - 1)), {})[rank] = left
                        break
                    left -= n
        open_ = narrower
    return found


def exact_quantiles(values: DataFrame, value: str, copies: str, shares: Sequence[float], buckets: int = BUCKETS) -> list:
    """The quantiles of a whole-number column whose rows count `copies` times, with linear interpolation.

    Null values and rows that count nothing are skipped; nulls for an input without others. The same values as an exact
    percentile over the written-out rows.
    """
    counted = values.select(F.col(value).cast(_WHOLE).alias("v"), F.col(copies).cast(_WHOLE).alias("n")).filter(
        F.col("v").isNotNull() & (F.col("n") > 0))
    counted = materialize(counted, "quantiles")
    total, low, high = counted.agg(F.sum("n"), F.min("v"), F.max("v")).first()
    if total is None:
        return [None for _ in shares]
    places = [share * (int(total) - 1) for share in shares]
    ranks = sorted({int(p) for p in places} | {min(int(p) + (p > int(p)), int(total) - 1) for p in places})
    at = _ranked(counted, ranks, int(low), int(high), buckets)

    def between(place: float) -> float:
        lower = int(place)
        upper = min(lower + (place > lower), int(total) - 1)
        if at[lower] == at[upper]:
            return float(at[lower])
        return (upper - place) * float(at[lower]) + (place - lower) * float(at[upper])

    return [between(p) for p in places]
