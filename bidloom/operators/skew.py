"""Left joins in which one key may hold a large share of the left rows.

AQE splits a skewed shuffle join only when both sides come straight from a shuffle. A right side that was reduced to
one row per key does not, so its hot keys are found and split here.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bidloom.operators.joins import BROADCAST_BYTES, broadcast_if_small, equal_on

# Rows of one key that a task can take; a heavier key is split into pieces of about this size.
HOT_ROWS = 1_000_000
# Keys that a sketch follows: one with 1/TRACKED of the rows cannot escape it. A lighter one may; that costs time only.
TRACKED = 20_000
# Sketches that the last merge reads, however many map tasks there are.
GROUPS = 64


@dataclass(frozen=True)
class HotKeys:
    """Hashes of hot keys and the number of pieces for each; at most TRACKED entries."""

    pieces: Mapping[int, int]

    def split(self, keys: Sequence[Column]) -> Column:
        """Number of pieces for a row's key, a power of two: 1 unless the key is hot."""
        classes: dict[int, list[int]] = {}
        for key_hash, pieces in self.pieces.items():
            classes.setdefault(1 << (pieces - 1).bit_length(), []).append(key_hash)
        key_hash, number = F.xxhash64(*keys), F
        for pieces, members in sorted(classes.items()):
            number = number.when(key_hash.isin(members), F.lit(pieces).cast("bigint"))
        return number.otherwise(F.lit(1).cast("bigint"))


def group_sketches(df: DataFrame, key_sets: Mapping[str, Sequence[str]]) -> DataFrame:
    """At most GROUPS rows with a frequent-items sketch for each key set: the first level of the merge."""
    hashed = df.select(F.pmod(F.spark_partition_id(), F.lit(GROUPS)).alias("_group"),
                       *[F.xxhash64(*keys).alias(name) for name, keys in key_sets.items()])
    return hashed.groupBy("_group").agg(
        *[F.expr(f"approx_top_k_accumulate({name}, {TRACKED})").alias(name) for name in key_sets])


def find(df: DataFrame, key_sets: Mapping[str, Sequence[str]], hot_rows: int = HOT_ROWS) -> dict[str, HotKeys]:
    """Hot keys of several key sets from one pass over their columns, whatever the size of `df`.

    The map tasks' sketches are merged by group and then once, so the last task reads a fixed number of them. No key
    is shuffled, and only keys over `hot_rows` come to the driver. Missing a key, or listing one too many, changes the
    spread of work and never the result.
    """
    # Grouped by a constant: an input without rows has no sketch to combine, and gives no row.
    merged = group_sketches(df, key_sets).groupBy(F.lit(0).alias("_all")).agg(
        *[F.expr(f"filter(approx_top_k_estimate(approx_top_k_combine({name}, {TRACKED}), {TRACKED}), "
                 f"k -> k.count > {hot_rows})").alias(name) for name in key_sets])
    row = merged.first()
    found = {name: [] if row is None else row[name] or [] for name in key_sets}
    return {name: HotKeys({r["item"]: -(-r["count"] // hot_rows) for r in keys}) for name, keys in found.items()}


def left_join(
    left: DataFrame,
    right: DataFrame,
    pairs: Sequence[tuple[str, str]],
    hot: HotKeys,
    spread_by: Sequence[str],
    null_safe: bool = False,
    computed: Mapping[str, Column] | None = None,
) -> DataFrame:
    """Left join whose hot left keys are spread over several tasks by a hash of other columns.

    The right rows of a hot key are repeated once per piece. Keep the right side small per key: one row is best.
    Equal keys must hash alike, so both sides need the same types. `computed` are left keys that are no columns, so a
    shuffle carries what they are made of.
    """
    if computed:
        keys = [computed.get(a, F.col(a)) for a, _ in pairs]
        on = [key == F.col(b) for key, (_, b) in zip(keys, pairs)]
        if hot.pieces:
            every = F.sequence(F.lit(0).cast("bigint"), hot.split([F.col(b) for _, b in pairs]) - 1)
            left = left.withColumn("_piece", F.pmod(F.xxhash64(*spread_by), hot.split(keys)))
            right = right.withColumn("_piece_r", F.explode(every))
            on.append(F.col("_piece") == F.col("_piece_r"))
        return left.join(right, on, "left").drop("_piece", "_piece_r")
    for a, b in pairs:
        if left.schema[a].dataType != right.schema[b].dataType:
            raise TypeError(f"{a} and {b} differ in type: cast one of them first")
    if not hot.pieces:
        return left.join(right, equal_on(left, right, pairs, null_safe), "left")
    own = F.pmod(F.xxhash64(*spread_by), hot.split([F.col(a) for a, _ in pairs]))
    every = F.sequence(F.lit(0).cast("bigint"), hot.split([F.col(b) for _, b in pairs]) - 1)
    salted_left = left.withColumn("_piece", own)
    salted_right = right.withColumn("_piece_r", F.explode(every))
    on = equal_on(salted_left, salted_right, pairs, null_safe) & (F.col("_piece") == F.col("_piece_r"))
    return salted_left.join(salted_right, on, "left").drop("_piece", "_piece_r")


def left_joins(
    left: DataFrame,
    sides: Sequence[tuple[DataFrame, Sequence[tuple[str, str]]]],
    hot: HotKeys,
    spread_by: Sequence[str],
    computed: Mapping[str, Column] | None = None,
) -> DataFrame:
    """Left joins to several sides on the same left keys, for one shuffle of the left rows.

    `computed` are left keys added after the shuffle and dropped at the end; the shuffle carries what they are made of,
    which pays for a long hash of a short value. Hot keys are spread as in `left_join`.
    """
    computed = dict(computed or {})
    names = [a for a, _ in sides[0][1]]
    if any([a for a, _ in pairs] != names for _, pairs in sides):
        raise ValueError("the sides must have the same left keys")
    keys = [computed.get(a, F.col(a)) for a in names]
    if hot.pieces:
        left = left.withColumn("_piece", F.pmod(F.xxhash64(*spread_by), hot.split(keys)))
        keys.append(F.col("_piece"))
    joined = left.repartition(*keys).withColumns(computed)
    for right, pairs in sides:
        for a, b in pairs:
            if joined.schema[a].dataType != right.schema[b].dataType:
                raise TypeError(f"{a} and {b} differ in type: cast one of them first")
        on = list(pairs)
        if hot.pieces:
            every = F.sequence(F.lit(0).cast("bigint"), hot.split([F.col(b) for _, b in pairs]) - 1)
            right = right.withColumn("_piece_r", F.explode(every))
            on.append(("_piece", "_piece_r"))
        joined = joined.join(right, equal_on(joined, right, on), "left").drop("_piece_r")
    return joined.drop("_piece", *computed)


def lookup(
    left: DataFrame, dimension: DataFrame, keys: Sequence[str], hot: HotKeys | None, spread_by: Sequence[str],
    limit: int = BROADCAST_BYTES, hot_rows: int = HOT_ROWS, side: DataFrame | None = None,
) -> DataFrame:
    """Left join to a dimension with one row per key: broadcast when it is measured small, else by shuffle with the
    hot left keys spread. They are searched for in `left`, and only for a shuffle, unless they are given. The
    dimension's key columns are dropped. `side` is what `broadcast_if_small` made of it, where that is known."""
    if side is None:
        side = broadcast_if_small(dimension, limit)
    if side is not dimension:
        return left.join(side, list(keys), "left")
    if hot is None:
        hot = find(left, {"key": keys}, hot_rows)["key"]
    renamed = {k: f"_dim_{k}" for k in keys}
    joined = left_join(left, dimension.withColumnsRenamed(renamed), list(renamed.items()), hot, spread_by)
    return joined.drop(*renamed.values())
