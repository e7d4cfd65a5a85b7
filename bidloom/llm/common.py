"""Column builders and joins that several operators share."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"
# What separates words: the six ASCII white-space characters.
SPACES = r"[\x20\x09-\x0D]+"
# Keys with at least one in HOT_SHARE of all rows are joined by broadcast; there can be no more than HOT_SHARE of them.
HOT_SHARE = 1000


def fresh(columns: Sequence[str], name: str) -> str:
    """`name`, with underscores in front until no column has it (names are compared without case)."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def words_of(text: Column, separator: str = SPACES) -> Column:
    """Non-empty pieces between separators; none for null."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), separator), lambda w: w != "")


def bound_to(value: Column, body) -> Column:
    """`body(value)` with `value` computed once, however often the body names it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def md5_number(*parts: Column) -> Column:
    """52 bits of the MD5 of the parts joined by '#': a number that SQL engines agree on."""
    return hex_number(F.md5(F.concat_ws("#", *parts)))


def hex_number(digest: Column) -> Column:
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("bigint")


def as_text(column: Column) -> Column:
    return F.coalesce(column.cast("string"), F.lit("null"))


def _same(left: DataFrame, right: DataFrame, pairs: Sequence[tuple[str, str]]) -> Column:
    return reduce(Column.__and__, [left[a].eqNullSafe(right[b]) for a, b in pairs])


def attach(rows: DataFrame, groups: DataFrame, keys: Sequence[str], count: str) -> DataFrame:
    """Inner join of rows to one row per group, of which one may hold any share of the rows.

    `groups` has the keys, `count` (rows of the group in `rows`) and further columns; null keys equal each other.
    Counts of different groups add up to the number of rows, so at most HOT_SHARE groups reach one in HOT_SHARE of
    them: these are broadcast, and the others, none of which is large, are joined by shuffle. Both inputs are read
    more than once: pass written tables or cheap scans.
    """
    total = groups.agg(F.sum(count)).first()[0] or 0
    least = max(1000, -(-total // HOT_SHARE))
    named = [(key, fresh([*rows.columns, *groups.columns], f"_key_{key}")) for key in keys]
    side = groups.withColumnsRenamed(dict(named))
    hot, cold = side.filter(F.col(count) >= least), side.filter(F.col(count) < least)
    of_hot = F.broadcast(hot)
    large = rows.join(of_hot, _same(rows, of_hot, named), "inner")
    rest = rows.join(of_hot, _same(rows, of_hot, named), "left_anti")
    small = rest.join(cold, _same(rest, cold, named), "inner")
    return large.unionByName(small).drop(*[b for _, b in named])


def running_total(df: DataFrame, group: Sequence[str], order: str, value: str, out: str, span: int = 1024) -> DataFrame:
    """Adds the sum of `value` over smaller `order` (a gapless-ish whole number, unique in its group).

    In two levels, so that no task holds more than `span` rows of a group, or one row per span.
    """
    part, before, amount = (fresh(df.columns, n) for n in ("_part", "_before", "_amount"))
    cut = df.withColumn(part, F.floor(F.col(order) / span))
    spans = cut.groupBy(*group, part).agg(F.sum(value).alias(amount))
    earlier = Window.partitionBy(*group).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    spans = spans.withColumn(before, F.coalesce(F.sum(amount).over(earlier), F.lit(0))).drop(amount)
    inside = Window.partitionBy(*group, part).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    cut = cut.withColumn(out, F.coalesce(F.sum(value).over(inside), F.lit(0)))
    pairs = [(c, fresh([*cut.columns, before], f"_span_{c}")) for c in (*group, part)]
    spans = spans.withColumnsRenamed(dict(pairs))
    joined = cut.join(spans, _same(cut, spans, pairs), "inner")
    return joined.withColumn(out, F.col(out) + F.col(before)).drop(part, before, *[b for _, b in pairs])


def row_key(columns: Sequence[str]) -> Column:
    """128 bits that stand for a whole row; equal rows have equal keys."""
    names = sorted(columns)
    return F.concat_ws("-", F.hex(F.xxhash64(*names)), F.hex(F.xxhash64(F.lit("row"), *names)))


def unfolded(df: DataFrame, count: str, step: int = 100_000) -> DataFrame:
    """Each row as often as `count` says, without that column; no array is longer than `step`."""
    part, one = (fresh(df.columns, n) for n in ("_part", "_one"))
    most = F.ceil(F.col(count) / step)
    split = df.filter(F.col(count) > 0).withColumn(part, F.explode(F.sequence(F.lit(1).cast("bigint"), most)))
    here = F.least(F.lit(step).cast("bigint"), F.col(count) - (F.col(part) - 1) * step)
    return split.withColumn(one, F.explode(F.sequence(F.lit(1).cast("bigint"), here))).drop(part, one, count)


def folded(rows: DataFrame, names: Sequence[str], key: str, repeats: str) -> DataFrame:
    """One of each group of rows with equal `key`, as the columns `names`; `repeats` is the size of the row's group.

    Rows that do not repeat are left alone; the others are reduced in the map tasks.
    """
    whole = fresh([*rows.columns, *names], "_whole")
    once = rows.filter(F.col(repeats) == 1).select(*names)
    often = rows.filter(F.col(repeats) > 1).groupBy(key).agg(F.first(F.struct(*names)).alias(whole))
    return once.unionByName(often.select(f"{whole}.*"))
