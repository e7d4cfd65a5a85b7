"""SimHash near-duplicates by a generalised pigeonhole.

Bits that vary together are grouped into partitions. If the partitions' thresholds t_i satisfy
sum(t_i + 1) = distance + 1, then two fingerprints within the distance are within t_i of each other on some partition.
The thresholds are unequal: dynamic programming picks those with the fewest estimated candidates. Each fingerprint is
filed under the bits it must share with a neighbour (a partition's bits but t_i of them), and the members of a bucket
are verified. Crowded buckets are divided again, down to buckets whose members are neighbours by construction, so
every link is found without listing the pairs of a crowd.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations, repeat
from math import comb

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bidloom.llm.common import attach, folded, fresh, row_key
from bidloom.session import materialize

BITS = 64
SHINGLE = 3
DISTANCE = 2
SEED = 42
# Fingerprints from which the partitions are fitted: a bounded sample; every fingerprint is indexed.
FIT_ROWS = 2048
# Members of a bucket that are compared with each other; larger buckets are divided.
BUCKET = 128
# Words whose hashes are in memory at once.
STEP = 1 << 16
ALL_BITS = (1 << BITS) - 1
_LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


# --- fingerprints -----------------------------------------------------------

def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """The SimHash of one text, as a signed 64-bit number: lower case, words between ASCII white space, word shingles.

    Fewer words than a shingle are one shingle; no words give 0. A bit is 1 if it is set in over half the hashes.
    """
    words = (text or "").encode("utf-8", "replace").translate(_LOWER).split()
    if not words:
        return 0
    line = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    width = min(shingle, len(words))
    first, last = starts[: len(words) - width + 1].tolist(), ends[width - 1:].tolist()
    counts = np.zeros(BITS, np.int64)
    for at in range(0, len(first), STEP):
        pieces = [line[a:b] for a, b in zip(first[at:at + STEP], last[at:at + STEP])]
        hashes = np.fromiter(map(xxhash.xxh64_intdigest, pieces, repeat(SEED)), np.uint64, len(pieces))
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits((counts * 2 > len(first)).astype(np.uint8), bitorder="little").view(np.int64)[0])


def with_fingerprints(docs: DataFrame, shingle: int = SHINGLE, text: str = "text", out: str = "fp") -> DataFrame:
    """Adds the fingerprint of every whole text."""
    @F.pandas_udf("bigint")
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([fingerprint(t, shingle) for t in texts], dtype="int64")

    return docs.withColumn(out, of(F.col(text)))


# --- the index --------------------------------------------------------------

@dataclass(frozen=True)
class Partition:
    bits: tuple[int, ...]
    threshold: int

    def masks(self) -> list[int]:
        """The sets of bits that a neighbour on this partition shares: all but `threshold` of them, in every way."""
        if self.threshold < 0:
            return []
        full = sum(1 << b for b in self.bits)
        return [full & ~sum(1 << b for b in free) for free in combinations(self.bits, self.threshold)]


def group_bits(sample: np.ndarray, groups: int) -> list[tuple[int, ...]]:
    """Partitions of about equal size: each takes the free bit most correlated with those it has."""
    bits = np.unpackbits(sample.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").astype(float)
    bits -= bits.mean(axis=0) if len(bits) else 0.0
    scale = np.sqrt((bits**2).sum(axis=0))
    scale[scale == 0] = 1.0
    alike = np.abs((bits / scale).T @ (bits / scale))
    np.fill_diagonal(alike, 0.0)
    free, out = list(range(BITS)), []
    for group in range(groups):
        size = (BITS - sum(map(len, out))) // (groups - group)
        taken = [max(free, key=lambda b: (alike[b, free].sum(), -b))]
        free.remove(taken[0])
        while len(taken) < size:
            taken.append(max(free, key=lambda b: (alike[b, taken].sum(), -b)))
            free.remove(taken[-1])
        out.append(tuple(sorted(taken)))
    return out


def _pair_share(sample: np.ndarray, bits: tuple[int, ...], most: int) -> list[float]:
    """Share of all pairs within 0, 1, ... `most` on these bits: measured, and not below that of random bits."""
    part = sample & np.uint64(sum(1 << b for b in bits))
    within = np.zeros(most + 1)
    for i in range(1, len(part)):
        apart = np.bitwise_count(part[:i] ^ part[i])
        within += [(apart <= t).sum() for t in range(most + 1)]
    pairs = max(1, len(part) * (len(part) - 1) // 2)
    random = np.cumsum([comb(len(bits), t) / 2.0 ** len(bits) for t in range(most + 1)])
    return list(np.maximum(within / pairs, random))


def allocate(costs: list[list[float]], units: int) -> list[int]:
    """Thresholds t_i with sum(t_i + 1) = units and the least total cost; costs[i][u] is that of u = t_i + 1 units."""
    best = {0: (0.0, [])}
    for row in costs:
        step: dict[int, tuple[float, list[int]]] = {}
        for used, (cost, chosen) in best.items():
            for u, more in enumerate(row):
                if used + u <= units and (used + u not in step or cost + more < step[used + u][0]):
                    step[used + u] = (cost + more, [*chosen, u - 1])
        best = step
    return best[units][1]


def fit(sample: np.ndarray, total: int, distance: int = DISTANCE) -> list[Partition]:
    """The partitions and thresholds with the least estimated work for `total` fingerprints.

    Work counts the filed rows and the candidates that meet in a bucket. Tried are 1 to 2 * (distance + 1) partitions.
    """
    found = []
    for groups in range(1, 2 * (distance + 1) + 1):
        parts = group_bits(sample, groups)
        costs = []
        for bits in parts:
            share = _pair_share(sample, bits, min(distance, len(bits)))
            # A pair that is close on a partition meets once for each way of leaving out its differing bits.
            costs.append([0.0] + [total * comb(len(bits), t) * 8.0 + share[t] * total * (total - 1) / 2
                                  * comb(len(bits), t) for t in range(len(share))])
        thresholds = allocate(costs, distance + 1)
        price = sum(row[t + 1] for row, t in zip(costs, thresholds))
        found.append((price, groups, [Partition(b, t) for b, t in zip(parts, thresholds)]))
    return min(found, key=lambda f: f[:2])[2]


def _signed(number: int) -> int:
    return number - (1 << BITS) if number >> (BITS - 1) else number


def _literals(masks: list[int]) -> Column:
    return F.array(*[F.lit(_signed(m)).cast("bigint") for m in masks])


def _close_pairs(members: Column, distance: int) -> Column:
    """The verified links among a bucket's members."""
    def near(a: Column) -> Column:
        others = F.filter(members, lambda b: (b > a) & (F.bit_count(a.bitwiseXOR(b)) <= distance))
        return F.transform(others, lambda b: F.struct(a.alias("a"), b.alias("b")))

    return F.flatten(F.transform(members, near))


def _linked(filed: DataFrame, distance: int, bucket: int) -> tuple[DataFrame, DataFrame]:
    """(links of the buckets of at most `bucket` members, filed rows of the larger buckets).

    `filed` has fp, mask and value = fp & mask. A bucket with any share of all rows is split off by its count.
    """
    sizes = filed.groupBy("mask", "value").agg(F.count(F.lit(1)).alias("members")).filter("members > 1")
    sizes = materialize(sizes, "simhash_buckets")
    crowded = attach(filed, sizes.filter(F.col("members") > bucket), ["mask", "value"], "members")
    # Buckets of two or more that are not crowded: each is gathered whole, and is small.
    quiet = filed.join(sizes.filter(F.col("members") > bucket).select("mask", "value"), ["mask", "value"], "left_anti")
    gathered = quiet.groupBy("mask", "value").agg(F.collect_list("fp").alias("fps")).filter(F.size("fps") > 1)
    links = gathered.select(F.explode(_close_pairs(F.col("fps"), distance)).alias("link")).select("link.a", "link.b")
    return links, crowded.select("fp", "mask", "value")


def links(classes: DataFrame, partitions: list[Partition], distance: int = DISTANCE, bucket: int = BUCKET) -> DataFrame:
    """a < b: pairs of different fingerprints within the distance that connect all that are within it.

    Level one files by the partitions. A crowded bucket's members agree on its mask; the other bits are cut into
    distance + 1 parts, on one of which neighbours agree, and the members are filed anew. What is still crowded is
    filed under all ways of leaving `distance` of the free bits out: such a bucket has at most 2^distance members, all
    of them neighbours. No level makes more rows than a fixed number for each fingerprint and bucket.
    """
    masks = [m for p in partitions for m in p.masks()]
    value = F.col("fp").bitwiseAND(F.col("mask")).alias("value")
    filed = classes.select("fp", F.explode(_literals(masks)).alias("mask")).select("fp", "mask", value)
    near, crowded = _linked(filed, distance, bucket)
    crowded = materialize(crowded, "simhash_crowded")
    parts = [sum(1 << b for b in range(j, BITS, distance + 1)) for j in range(distance + 1)]
    finer = F.transform(_literals(parts), lambda p: F.col("mask").bitwiseOR(p))
    again = crowded.select("fp", F.explode(finer).alias("mask")).select("fp", "mask", value).distinct()
    near_again, dense = _linked(again, distance, bucket)
    left_out = F.filter(_literals([1 << b for b in range(BITS)]), lambda b: F.col("mask").bitwiseAND(b) == 0)
    dense = dense.select("fp", left_out.alias("choice"), F.lit(0).cast("bigint").alias("out"))
    for _ in range(distance):
        dense = dense.select("fp", "choice", F.explode("choice").alias("one"), "out").select(
            "fp", F.filter("choice", lambda c: c >= F.col("one")).alias("choice"),
            F.col("out").bitwiseOR(F.col("one")).alias("out"))
    kept = F.bitwise_not("out")
    cliques = dense.select("fp", kept.alias("mask"), F.col("fp").bitwiseAND(kept).alias("value")).groupBy(
        "mask", "value").agg(F.collect_set("fp").alias("fps")).filter(F.size("fps") > 1)
    hub = F.array_min("fps")
    spokes = cliques.select(hub.alias("a"), F.explode("fps").alias("b")).filter("a <> b")
    return near.unionByName(near_again).unionByName(spokes).distinct()


# --- components -------------------------------------------------------------

def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One star step on edges (u, v): the neighbours of u move to the smallest of them and u."""
    if large:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:
        both = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    both = materialize(both.distinct(), "simhash_edges")
    least = materialize(both.groupBy("u").agg(F.min("v").alias("m"), F.count(F.lit(1)).alias("n")), "simhash_least")
    joined = attach(both, least, ["u"], "n").withColumn("m", F.least("u", "m"))
    if large:
        moved = joined.filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        own = least.select("u", F.least("u", "m").alias("v"))
        moved = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(own)
    return moved.filter("u <> v").distinct()


def components(edges: DataFrame) -> DataFrame:
    """node, root: the smallest node of each component, from edges (a, b), by alternating stars.

    Every round is a written table; a node with any number of edges is split. The rounds grow with the logarithm of
    the longest chain.
    """
    state = materialize(edges.select(F.col("a").alias("u"), F.col("b").alias("v")), "simhash_star")
    before = None
    while True:
        state = materialize(_star(_star(state, True), False), "simhash_star")
        now = state.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now[0] == 0 or now == before:
            return state.select(F.col("u").alias("node"), F.col("v").alias("root"))
        before = now


def groups(prints: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """fp, root, copies, component_id: one row per fingerprint of `prints` (fp, doc_id; a written table).

    component_id is the smallest doc_id of the component (null if none of its rows has one).
    """
    classes = materialize(prints.groupBy("fp").agg(
        F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("copies")), "simhash_classes")
    # A bounded sample for the fit: the fingerprints of the smallest hash.
    rows = classes.orderBy(F.xxhash64("fp"), "fp").limit(FIT_ROWS).select("fp").collect()
    sample = np.array([r["fp"] for r in rows], dtype=np.int64).view(np.uint64)
    found = links(classes, fit(sample, classes.count(), distance), distance)
    roots = components(found)
    side = roots.withColumnRenamed("node", "_node")
    rooted = classes.join(side, classes["fp"] == side["_node"], "left").select(
        "fp", "least", "copies", F.coalesce("root", "fp").alias("root"))
    rooted = materialize(rooted, "simhash_rooted")
    each = materialize(rooted.groupBy("root").agg(
        F.min("least").alias("component_id"), F.count(F.lit(1)).alias("members")), "simhash_components")
    return materialize(attach(rooted, each, ["root"], "members").select("fp", "root", "copies", "component_id"),
                       "simhash_groups")


def component_table(docs: DataFrame, shingle: int = SHINGLE, distance: int = DISTANCE) -> DataFrame:
    """One row per document: doc_id, fingerprint (16 hex digits), component_id.

    Null and empty texts have the fingerprint zero and are linked like any other. Repeated rows stay. No rows for an
    empty table.
    """
    prints = materialize(with_fingerprints(docs.select("doc_id", "text"), shingle).select("doc_id", "fp"), "simhash_fp")
    joined = attach(prints, groups(prints, distance), ["fp"], "copies")
    return joined.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def survivors(docs: DataFrame, shingle: int = SHINGLE, distance: int = DISTANCE) -> DataFrame:
    """One document of each group, with all its columns: that of the smallest doc_id (null last), then of the smallest
    row key; of equal rows, one."""
    names = docs.columns
    key, repeats = fresh(names, "_dedup_key"), fresh(names, "_dedup_repeats")
    keyed = docs.select("doc_id", "text", row_key(names).alias("key"))
    prints = materialize(with_fingerprints(keyed).select("doc_id", "key", "fp"), "simhash_fp")
    rows = attach(prints, groups(prints.select("doc_id", "fp"), distance), ["fp"], "copies")
    order = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "key")
    # The count of rows equal to the first one comes with the minimum: partial sums by row key, then the least key.
    same = rows.groupBy("root", "doc_id", "key").agg(F.count(F.lit(1)).alias("repeats"))
    first = same.groupBy("root").agg(F.min(F.struct(order.alias("order"), "repeats")).alias("first"))
    kept = materialize(first.select(F.col("first.order.key").alias(key), F.col("first.repeats").alias(repeats)),
                       "simhash_kept")
    return folded(attach(docs.withColumn(key, row_key(names)), kept, [key], repeats), names, key, repeats)
