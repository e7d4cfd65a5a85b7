"""Order-free sums of doubles.

A double sum depends on the order rows arrive in, so a retried task can change the last digits. Values are taken at
PLACES decimal places, enough for any product of a price, a modifier and a score, and summed as decimals: the sum is
exact, and the one division or rounding comes at the end. Whole part and fraction are scaled apart, so a value has its
places at any size; one that is not finite or has 19 digits before the point raises an error.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

PLACES = 12
# Doubles from here on have no exact bigint.
_LIMIT = float(1 << 63)


def units(value: Column) -> Column:
    """The value in units of the last place, as a decimal."""
    value = value.cast("double")
    refused = F.isnan(value) | (F.abs(value) >= F.lit(_LIMIT))
    whole = F.when(refused, F.raise_error(F.lit("value is too large for an exact sum")).cast("bigint")).otherwise(
        value.cast("bigint"))
    rest = F.floor((value - whole.cast("double")) * F.lit(10.0**PLACES) + F.lit(0.5))
    return whole.cast("decimal(20,0)") * F.lit(10**PLACES).cast("decimal(13,0)") + rest.cast("decimal(14,0)")


def money_sum(value: Column, shown: int = 2) -> Column:
    """Sum of the values, rounded half away from zero to `shown` places once, at the end."""
    return _shown(F.sum(units(value)), shown)


def _shown(total: Column, shown: int) -> Column:
    step = 10 ** (PLACES - shown)
    size = F.call_function("div", F.abs(total) + F.lit(step // 2).cast("decimal(14,0)"), F.lit(step).cast("decimal(14,0)"))
    return F.when(total < 0, -size).otherwise(size).cast("double") / F.lit(10.0**shown)


def money_sum_sql(value: str, shown: int = 2) -> str:
    """`money_sum` as Spark SQL text; a value that is too large raises an error where ANSI mode is on."""
    step = 10 ** (PLACES - shown)
    whole, rest = f"CAST({value} AS BIGINT)", f"({value}) - CAST(CAST({value} AS BIGINT) AS DOUBLE)"
    total = (f"sum(CAST({whole} AS DECIMAL(20,0)) * {10**PLACES} "
             f"+ CAST(floor(({rest}) * 1e{PLACES} + CAST(0.5 AS DOUBLE)) AS DECIMAL(14,0)))")
    return f"CAST(sign({total}) * ((abs({total}) + {step // 2}) div {step}) AS DOUBLE) / CAST({10**shown} AS DOUBLE)"


def weighted_units(value: Column, weight: Column) -> Column:
    """Sum of the units of rows that count `weight` times."""
    return F.sum(units(value) * weight.cast("decimal(17,0)"))


def present(value: Column, weight: Column) -> Column:
    """Rows with a value, each counted `weight` times; a bigint, a third as wide in an aggregate as a decimal."""
    return F.sum(F.when(value.isNotNull(), weight).otherwise(F.lit(0)).cast("bigint"))


def quotient(total: Column, count: Column) -> Column:
    """The mean from a sum of units and a count; null for none."""
    return total.cast("double") / F.nullif(count.cast("double") * F.lit(10.0**PLACES), F.lit(0.0))


def mean(value: Column, weight: Column | None = None) -> Column:
    """Mean that skips nulls; each row counts `weight` times."""
    weight = F.lit(1).cast("bigint") if weight is None else weight
    return quotient(weighted_units(value, weight), present(value, weight))
