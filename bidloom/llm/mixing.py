"""Mixing sources to target weights by a splitting tree over exact block quotas.

1. Each source's documents are dealt to blocks by a hash: block 0, 1, 2 ... is a random permutation of them.
2. The target of a source becomes a quota of blocks: all blocks for each full pass, then the first blocks of one more
   pass, of which the last is filled document by document.
3. A tree splits the quotas among the output shards. Each node deals its tickets (one per block and pass) by a random
   ranking, a fixed number to either side: the sources' counts on a side are a multivariate hypergeometric draw.
4. A leaf's counts say how many of the source's permuted blocks it gets, the next ones in order, so shards are disjoint
   and add up to the quotas. The drawn rows are shuffled within their shard only, by a sort on a random number.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bidloom.llm.common import as_text, attach, folded, fresh, hex_number, md5_number, row_key, running_total, unfolded
from bidloom.session import materialize

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST = 2.0
SHARDS = 8
# Distinct documents of a block, about.
BLOCK = 256
SEED = "mix"
# Tickets of a cell, about: the tree's nodes are ranked cell by cell, by the first hex digits of a ticket's MD5.
CELL = 1 << 16
# Numbers that are unfolded in one row.
UNFOLD = 10_000


def word_count(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(r"[^\x20\x09-\x0D]+")).cast("bigint")


def source_targets(sizes: DataFrame, weights: Sequence[float], share: float, most: float) -> DataFrame:
    """Adds `target` to one row per source with `source_size`.

    The sources in order (null last) take the weights in turn and share `share` times all sizes; a target stops at
    `most` times its source's size and the excess is shared anew until none is above. That is one water level: sorted
    by size over weight, the first sources are full and the others take level times weight.
    Sorts one row per source in one task.
    """
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (rank % len(weights) + 1).cast("int"))
    weighed = sizes.withColumn("weight", weight)
    order = Window.orderBy((F.col("source_size") / F.col("weight")), F.col("source").asc_nulls_last())
    earlier, every = order.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy()
    full = F.col("source_size") * F.lit(float(most))
    level = ((F.sum("source_size").over(every) * F.lit(float(share))
              - F.coalesce(F.sum(full).over(earlier), F.lit(0.0)))
             / (F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(earlier), F.lit(0.0))))
    # With the sources before it full, a source is the first that is not if the level then is below its own mark.
    leveled = weighed.withColumn("level", level).withColumn(
        "open", F.col("level") * F.col("weight") <= full)
    final = F.min(F.when(F.col("open"), F.struct((F.col("source_size") / F.col("weight")).alias("at"), "level"))).over(every)
    water = F.coalesce(final["level"], F.lit(float("inf")))
    return leveled.withColumn("target", F.least(full, water * F.col("weight"))).drop("weight", "level", "open")


def _pass_state(targets: DataFrame) -> DataFrame:
    """`passes` (full ones), `part` (words of one more) and `blocks` of each source."""
    passes = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0))
    part = F.col("target") - passes * F.col("source_size")
    blocks = F.greatest(F.ceil(F.col("documents") / BLOCK), F.lit(1))
    return targets.withColumns({"passes": passes.cast("bigint"), "part": part, "blocks": blocks.cast("bigint")})


def _fill(items: Column, room: Column) -> Column:
    """How many of each item's repeats fit, first come first served: items (size, repeats) in random order."""
    start = F.struct(room.alias("room"), F.array().cast("array<bigint>").alias("taken"))

    def step(state, item):
        fits = F.when(item["size"] == 0, item["repeats"]).otherwise(
            F.least(item["repeats"], F.floor(state["room"] / item["size"]))).cast("bigint")
        return F.struct((state["room"] - fits * item["size"]).alias("room"),
                        F.concat(state["taken"], F.array(fits)).alias("taken"))

    return F.aggregate(items, start, step)["taken"]


def counted_out(df: DataFrame, count: str, out: str) -> DataFrame:
    """Each row as often as `count` says, numbered from 1 in `out`; the numbers of one row are spread over tasks."""
    part, one = fresh(df.columns, "_part"), F.lit(1).cast("bigint")
    parts = df.filter(F.col(count) > 0).withColumn(part, F.explode(F.sequence(one - 1, F.floor((F.col(count) - 1) / UNFOLD))))
    spread = parts.repartition(F.xxhash64(*parts.columns))
    first = F.col(part) * UNFOLD
    return spread.withColumn(out, F.explode(F.sequence(first + 1, F.least(first + UNFOLD, F.col(count))))).drop(part)


def split_quotas(quotas: DataFrame, shards: int, seed: str = SEED) -> DataFrame:
    """source, shard, blocks: the quotas of `quotas` (source, quota), split over the shards by the tree.

    A node with k of the shards gives a part of its tickets to the left, in proportion to the shards there, rounded
    down: those that rank first by an MD5 of seed, level and ticket. Nodes rank cell by cell, so no task holds the
    tickets of a whole node.
    """
    total = quotas.agg(F.sum("quota")).first()[0] or 0
    digits = max(2, math.ceil(math.log(max(float(total) / CELL, 1.0), 16)))
    tickets = counted_out(quotas.select("source", "quota"), "quota", "ticket").drop("quota")
    state = tickets.withColumns({"first": F.lit(0), "width": F.lit(shards)})
    for depth in range((shards - 1).bit_length()):
        key = F.md5(F.concat_ws("#", F.lit(f"{seed}#{depth}"), as_text(F.col("source")), F.col("ticket")))
        keyed = state.withColumn("key", key).withColumn("cell", F.substring("key", 1, digits))
        cells = keyed.groupBy("first", "cell").agg(F.count(F.lit(1)).alias("n"))
        node = Window.partitionBy("first")
        cells = cells.withColumns({
            "before": F.coalesce(F.sum("n").over(
                node.orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)),
            "all": F.sum("n").over(node),
        }).drop("n")
        inside = Window.partitionBy("first", "cell").orderBy("key", F.col("source").asc_nulls_first(), "ticket")
        ranked = keyed.withColumn("rank", F.row_number().over(inside)).join(cells, ["first", "cell"])
        left = F.floor(F.col("width") / 2).cast("int")
        goes_left = F.col("rank") + F.col("before") <= F.floor(F.col("all") * left / F.col("width"))
        state = ranked.select(
            "source", "ticket", F.when(goes_left, F.col("first")).otherwise(F.col("first") + left).alias("first"),
            F.when(goes_left, left).otherwise(F.col("width") - left).alias("width"))
    return state.groupBy("source", F.col("first").alias("shard")).agg(F.count(F.lit(1)).alias("blocks"))


def plan(items: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE, most: float = MOST,
         shards: int = SHARDS, seed: str = SEED) -> DataFrame:
    """The drawing of each item: its columns and `source_size`, `target`, `draws` (a list of shards per repeat).

    `items`: source, doc_id, size, row_key, row_md5 and `repeats` (how often the row occurs), distinct, best a written table. The result
    has one row per item and outcome, with `times`, the number of its repeats that have this outcome. Every item is
    kept, also those that are drawn nowhere. A source of size 0 has target 0. Reruns agree: nothing depends on the
    order or partitioning of the rows.
    """
    per_source = items.groupBy("source").agg(
        F.sum(F.col("size") * F.col("repeats")).alias("source_size"), F.count(F.lit(1)).alias("documents"))
    states = materialize(_pass_state(source_targets(per_source, weights, share, most)), "mix_sources")
    order = F.md5(F.concat_ws("#", F.lit(seed), as_text(F.col("doc_id")), F.col("size"), "row_md5"))
    placed = attach(items, states, ["source"], "documents").withColumn("order", order)
    placed = placed.withColumn("block", F.pmod(hex_number(F.col("order")), F.col("blocks")))
    sums = placed.groupBy("source", "block").agg(
        F.sum(F.col("size") * F.col("repeats")).alias("words"), F.max("part").alias("part"))
    sums = materialize(running_total(sums, ["source"], "block", "words", "before"), "mix_blocks")
    # The last block of the extra pass is the one in which the part's words run out.
    last = sums.filter((F.col("before") < F.col("part")) & (F.col("before") + F.col("words") >= F.col("part")))
    last = last.groupBy("source").agg(F.min(F.struct("block", "before")).alias("at"))
    last = last.select("source", F.col("at.block").alias("last_block"), F.col("at.before").alias("last_before"))
    full = _joined_sources(states, last).withColumns({
        "last_block": F.coalesce("last_block", F.lit(-1)), "room": F.col("part") - F.coalesce("last_before", F.lit(0)),
    })
    full = full.withColumn("quota", F.col("passes") * F.col("blocks") + F.col("last_block") + 1)
    counts = split_quotas(full.select("source", "quota").filter("quota > 0"), shards, seed)
    starts = counts.withColumn("start", F.coalesce(F.sum("blocks").over(
        Window.partitionBy("source").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    starts = starts.groupBy("source").agg(F.sort_array(F.collect_list(F.struct("start", "shard"))).alias("starts"))
    full = materialize(_joined_sources(full, starts), "mix_plan")
    placed = attach(items, full, ["source"], "documents").withColumn("order", order)
    placed = placed.withColumn("block", F.pmod(hex_number(F.col("order")), F.col("blocks")))
    whole = placed.filter(F.col("block") != F.col("last_block")).withColumns({
        "times": F.col("repeats"), "extra": (F.col("block") < F.col("last_block")).cast("bigint")})
    edge = placed.filter(F.col("block") == F.col("last_block")).groupBy("source", "block").agg(
        F.sort_array(F.collect_list(F.struct("order", "row_key", "doc_id", "size", "repeats"))).alias("items"),
        *[F.first(c).alias(c) for c in ("source_size", "target", "passes", "blocks", "room", "starts")])
    edge = edge.withColumn("taken", _fill(F.col("items"), F.col("room")))
    edge = edge.withColumn("item", F.explode(F.arrays_zip("items", "taken")))
    outcome = F.array(
        F.struct(F.lit(1).cast("bigint").alias("extra"), F.col("item.taken").alias("times")),
        F.struct(F.lit(0).cast("bigint").alias("extra"), (F.col("item.items.repeats") - F.col("item.taken")).alias("times")))
    edge = edge.withColumn("outcome", F.explode(outcome)).select(
        "source", "block", "item.items.doc_id", "item.items.row_key", F.col("item.items.size").alias("size"),
        "source_size", "target", "passes", "blocks", "starts", F.col("outcome.extra").alias("extra"),
        F.col("outcome.times").alias("times")).filter("times > 0")
    decided = whole.select(*edge.columns).unionByName(edge)
    number = F.col("passes") + F.col("extra")
    ticket = F.transform(F.sequence(F.lit(1).cast("bigint"), number), lambda p: (p - 1) * F.col("blocks") + F.col("block"))
    shard_of = lambda t: F.element_at(F.filter("starts", lambda s: s["start"] <= t), -1)["shard"]
    draws = F.when(number > 0, F.transform(ticket, shard_of)).otherwise(F.array().cast("array<int>"))
    return decided.select("source", "doc_id", "size", "row_key", "source_size", "target", "times", draws.alias("draws"))


def _joined_sources(left: DataFrame, right: DataFrame) -> DataFrame:
    """Left join of two tables that have one row per source."""
    side = right.withColumnRenamed("source", "_source")
    return left.join(side, left["source"].eqNullSafe(side["_source"]), "left").drop("_source")


def items_of(docs: DataFrame) -> DataFrame:
    """source, doc_id, size, row_key, row_md5, repeats: the distinct rows of `docs`, written once. Null text: size 0.

    `row_md5` is that of all columns, which tells apart rows of one doc_id: they are dealt to blocks one by one.
    """
    whole = F.md5(F.concat_ws("#", *[as_text(F.col(c)) for c in sorted(docs.columns)]))
    slim = docs.select("source", "doc_id", word_count(F.col("text")).alias("size"), row_key(docs.columns).alias("row_key"),
                       whole.alias("row_md5"))
    grouped = slim.groupBy("source", "doc_id", "size", "row_key", "row_md5").agg(F.count(F.lit(1)).alias("repeats"))
    return materialize(grouped, "mix_items")


def mix_table(docs: DataFrame, **options) -> DataFrame:
    """One row per document: doc_id, size, source_size, target, taken, shards (of its draws, comma-joined).

    Null text has size 0 and is never drawn for words; a source of size 0 has target 0. An empty table gives no rows.
    """
    return unfolded(plan(items_of(docs), **options), "times").select(
        "doc_id", "size", "source_size", "target", (F.col("size") * F.size("draws")).alias("taken"),
        F.array_join(F.col("draws").cast("array<string>"), ",").alias("shards"))


def drawn_rows(docs: DataFrame, shard: str, place: str, seed: str = SEED, **options) -> DataFrame:
    """The columns of `docs`, `shard` and `place`: one row per draw, none for a document drawn nowhere.

    `place` is a random number by which a shard is shuffled. Rows that repeat are folded before they meet, so a row may
    repeat any number of times.
    """
    names = docs.columns
    key, draws, repeats, copies, one = (fresh([*names, shard, place], n) for n in (
        "_mix_key", "_mix_draws", "_mix_repeats", "_mix_copies", "_mix_copy"))
    decided = plan(items_of(docs), seed=seed, **options)
    totals = decided.groupBy(F.col("row_key").alias(key)).agg(F.sum("times").alias(repeats))
    by_shard = decided.select(F.col("row_key").alias(key), F.explode("draws").alias("shard"), "times").groupBy(
        key, "shard").agg(F.sum("times").alias("copies"))
    # At most one entry per shard.
    listed = by_shard.groupBy(key).agg(F.sort_array(F.collect_list(F.struct("shard", "copies"))).alias(draws))
    wanted = materialize(totals.join(listed, key), "mix_draws")
    rows = attach(docs.withColumn(key, row_key(names)), wanted, [key], repeats)
    each = folded(rows, [*names, key, draws], key, repeats).withColumn(draws, F.explode(draws))
    each = each.withColumns({shard: F.col(draws)["shard"], copies: F.col(draws)["copies"]}).drop(draws)
    once = each.filter(F.col(copies) == 1).withColumn(one, F.lit(1).cast("bigint"))
    often = counted_out(each.filter(F.col(copies) > 1), copies, one)
    number = md5_number(F.lit(seed), F.col(key), F.col(shard).cast("string"), F.col(one).cast("string"))
    return once.unionByName(often).withColumn(place, number).select(*names, shard, place)


def arranged(rows: DataFrame, shard: str, place: str) -> DataFrame:
    """Rows shard by shard, each shuffled: shards and parts of them lie in key ranges, each a local sort."""
    return rows.repartitionByRange(shard, place).sortWithinPartitions(shard, place)


def mixed(docs: DataFrame, **options) -> DataFrame:
    """The documents of the mix with all their columns: one row per draw, shard by shard, each shard shuffled.

    Extra columns stay. An empty table gives no rows.
    """
    shard, place = fresh(docs.columns, "_mix_shard"), fresh(docs.columns, "_mix_place")
    return arranged(drawn_rows(docs, shard, place, **options), shard, place).select(*docs.columns)
