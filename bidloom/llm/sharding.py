"""Rendezvous hashing of stable record keys over weighted shards."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bidloom.llm.common import as_text, fresh, md5_number
from bidloom.session import materialize

# Slots of one group of equal records that are unfolded at once.
UNFOLD = 100_000


def _score(key: Column, shard: int, weight: float) -> Column:
    """ln(u) / weight of a uniform u drawn by the key and the shard: the largest wins in proportion to its weight."""
    uniform = (md5_number(key, F.lit(str(shard))) + F.lit(0.5)) / F.lit(float(2**52))
    return F.struct((F.ln(uniform) / F.lit(float(weight))).alias("score"), F.lit(-shard).alias("rank"))


def best_shard(key: Column, weights: Sequence[float]) -> Column:
    """The shard of a key (text, never null). It depends on the key and the weights alone.

    A new shard at the end of the list wins the keys that score highest there; no other key moves. Ties go to the
    smaller shard.
    """
    if not weights or min(weights) <= 0:
        raise ValueError("weights must be positive")
    scores = [_score(key, shard, weight) for shard, weight in enumerate(weights)]
    best = F.greatest(*scores) if len(scores) > 1 else scores[0]
    return (-best["rank"]).cast("int")


def shards(docs: DataFrame, key: str, weights: Sequence[float], added: float | None = None) -> DataFrame:
    """Adds `shard` and, if the weight of one more shard is given, `grown_shard`. No shuffle.

    Rows with equal keys share a shard; a null key counts as the text 'null'. Columns of these names are replaced.
    """
    out = docs.withColumn("shard", best_shard(as_text(docs[key]), weights))
    if added is None:
        return out
    return out.withColumn("grown_shard", best_shard(as_text(docs[key]), [*weights, added]))


def numbered(rows: DataFrame, shard: str, key: str) -> DataFrame:
    """Adds `slot`: gapless numbers from 0 in each shard, in the order of the key's MD5, then of all columns.

    Equal rows are folded to one with a count first, so a record repeated any number of times is one row to sort. The
    rows are cut into key ranges of about equal size, written, and numbered range by range: no task holds a whole shard,
    nor all rows of one key. Rows stay whole; empty input gives no rows.
    """
    names = [fresh(rows.columns, n) for n in ("_md5", "_range", "_n", "_first", "_before", "_part")]
    md5, range_, n, first, before, part = names
    columns = rows.columns
    folded = rows.groupBy(*columns).agg(F.count(F.lit(1)).alias(n)).withColumn(md5, F.md5(as_text(F.col(key))))
    order = [F.col(c).asc_nulls_first() for c in (md5, *columns)]
    # Written: the bounds of the ranges come from a sample, which another run of the plan need not repeat.
    ranged = materialize(folded.repartitionByRange(F.col(shard).asc_nulls_first(), *order).withColumn(
        range_, F.spark_partition_id()), "shard_ranges")
    sizes = ranged.groupBy(shard, range_).agg(F.sum(n).alias(before))
    earlier = Window.partitionBy(shard).orderBy(range_).rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.withColumn(before, F.coalesce(F.sum(before).over(earlier), F.lit(0)))
    inside = Window.partitionBy(shard, range_).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    placed = ranged.withColumn(first, F.coalesce(F.sum(n).over(inside), F.lit(0)))
    placed = placed.join(sizes, [shard, range_]).withColumn(first, F.col(first) + F.col(before))
    # A group of many equal records unfolds in two steps, so that no array grows with the group.
    placed = placed.withColumn(part, F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor((F.col(n) - 1) / UNFOLD))))
    first_slot = F.col(first) + F.col(part) * UNFOLD
    last_slot = F.least(first_slot + UNFOLD, F.col(first) + F.col(n)) - 1
    return placed.withColumn("slot", F.explode(F.sequence(first_slot, last_slot))).select(*columns, "slot")


def record_table(docs: DataFrame, weights: Sequence[float], added: float) -> DataFrame:
    """One row per document: doc_id, size (UTF-8 bytes plus 16), text_crc32, shard, grown_shard, slot.

    Null text has size 16 and the CRC of no bytes. Repeated rows get slots of their own in the same shard.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    slim = docs.select(
        "doc_id",
        (F.octet_length(text) + 16).cast("bigint").alias("size"),
        F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"),
    )
    return numbered(shards(slim, "doc_id", weights, added), "shard", "doc_id")
