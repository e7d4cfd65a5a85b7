"""Word n-gram Jaccard join by segments of the sets.

A document's set is its distinct n-grams, as 64-bit hashes. The hash range is cut into segments, a little more of them than
n-grams in which two linked sets of that size can differ at most (D). Each n-gram that only one of two sets has spoils one
segment, so linked sets agree on whole segments, and the first one that they agree on, in any order that all sets keep,
is among the first D + 1 of either. A set is filed under these: the segments with the most n-grams. Sets that are alike in a
few lines only seldom agree on a whole segment, so the filed rows need neither frequencies nor a common order of n-grams.
How many segments there are depends on a range of sizes; a set is also filed by the range below if a smaller set that it
can be linked to lies there.

Buckets with the same members become one. A bucket is first compared with one of its members, in a few rounds with another
one if many are left. What is linked by then needs no further comparison, so a large group of near copies costs a few
comparisons a member. Then the members outside a bucket's largest component, if they are at most BUCKET, are compared
with all others. The members of buckets that still have more are filed again, by other segments. What is still crowded
then is compared in blocks of BUCKET members. Of all these pairs only those that pass a length filter and whose sketches
(the parity of the n-grams at each of SKETCH bits, which differs in at most as many bits as the sets in n-grams) are near
enough are verified, once each.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StructField, StructType

from bidloom.llm.common import attach
from bidloom.llm.simhash import components
from bidloom.llm.tokens import mixed
from bidloom.session import materialize

SHINGLE = 4
# Links need this many hundredths of the union in common.
PERCENT = 85
# Members of a bucket that are compared with all of it; buckets with more outside their largest component are divided.
BUCKET = 128
# Rounds with one member of each bucket, and ways to cut segments that are tried before blocks are compared.
ROUNDS, DEEPEST = 2, 2
# A range of set sizes ends at this many hundredths of its start, if linked sets cannot be farther apart.
RANGE = 140
# Bits of a sketch.
SKETCH = 512
# The filters of documents and sets to be compared: SEGMENTS of SEGMENT_BITS bits, PROBES bits for each; 16 MiB at every size.
SEGMENTS, SEGMENT_BITS, PROBES = 256, 1 << 19, 4
# Pairs of one document that are verified in one task.
VERIFIED = 1024
# Links that are joined to components in one task; more of them are joined in rounds of the whole cluster.
FEW = 1 << 16
# Sets that are picked by their ids; more of them are picked by a filter of fixed size.
SENT = 1 << 16
# Sets that a task remembers as met.
MET = 1 << 18
# Bytes of a text that are split at once, words that are remembered, and words that are hashed at once.
PIECE, REMEMBERED, STEP = 1 << 20, 1 << 18, 1 << 19
_SEED = 42
_ODD = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)]
_LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
_SPACE = re.compile(rb"[\x20\x09-\x0D]")


# --- sets -------------------------------------------------------------------

class _WordHashes(dict):
    """Hashes of words; the first REMEMBERED ones, among them the frequent ones, are kept."""

    def __missing__(self, word: bytes) -> int:
        code = xxhash.xxh64_intdigest(word, _SEED)
        if len(self) < REMEMBERED:
            self[word] = code
        return code


def _pieces(raw: bytes) -> Iterator[bytes]:
    """The text in pieces that end between words."""
    start = 0
    while start < len(raw):
        end = min(start + PIECE, len(raw))
        space = _SPACE.search(raw, end) if end < len(raw) else None
        end = space.start() if space else len(raw)
        yield raw[start:end]
        start = end


def ngram_sets(texts: list[str | None], ngram: int, known: dict) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, sizes): the distinct hashes of each text's word n-grams, sorted, one text after the other.

    A text with fewer words than an n-gram has one hash, a text without words none.
    """
    parts, lengths = [], np.zeros(len(texts), np.int64)
    for at, text in enumerate(texts):
        for piece in _pieces((text or "").encode("utf-8", "replace").translate(_LOWER)):
            words = piece.split()
            lengths[at] += len(words)
            parts.append(np.fromiter(map(known.__getitem__, words), np.uint64, len(words)))
    words = np.concatenate(parts) if parts else np.zeros(0, np.uint64)
    many = max(len(words) - ngram + 1, 0)
    hashes = words[:many] + np.uint64(ngram)
    for k in range(1, ngram):
        hashes = mixed(hashes) + words[k:k + many]
    hashes = mixed(hashes)
    out, end = [], 0
    for length in lengths.tolist():
        start, end = end, end + length
        if length >= ngram:
            own = np.sort(hashes[start:end - ngram + 1])
            out.append(own[np.append(True, own[1:] != own[:-1])])
        elif length:
            code = words[start:start + 1] + np.uint64(length)
            for k in range(1, length):
                code = mixed(code) + words[start + k:start + k + 1]
            out.append(mixed(code))
        else:
            out.append(words[:0])
    sizes = np.array([len(s) for s in out], np.int64)
    return (np.concatenate(out) if out else words), sizes


def _texts(batches: Iterator[pa.RecordBatch], ngram: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Slices of the rows with their sets, of about STEP words each."""
    known = _WordHashes()
    for batch in batches:
        texts, start, size = batch.column(batch.schema.get_field_index("text")).to_pylist(), 0, 0
        for at, text in enumerate(texts):
            size += len(text or "") // 6
            if size >= STEP or at == len(texts) - 1:
                yield batch.slice(start, at + 1 - start), *ngram_sets(texts[start:at + 1], ngram, known)
                start, size = at + 1, 0


def _ids(hashes: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """64 bits that stand for each whole set; equal sets have equal ones."""
    # Sums over each row's hashes, from running sums: unsigned numbers wrap around.
    ends, out = np.cumsum(sizes), sizes.astype(np.uint64)
    for values in (hashes, mixed(hashes ^ np.uint64(0x5851F42D4C957F2D))):
        running = np.append(np.uint64(0), np.cumsum(values, dtype=np.uint64))
        out = mixed(out * _ODD[0] + running[ends] - running[ends - sizes])
    return out


# --- segments ---------------------------------------------------------------

def _differ(total: np.ndarray, percent: int) -> np.ndarray:
    """The most n-grams in which two linked sets, of `total` n-grams together, differ."""
    return (100 - percent) * total // (100 + percent)


def _ranges(most: int, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """(starts, segments) of the ranges of set sizes up to `most`."""
    step, starts = max(RANGE, -(-10000 // percent)), [1]
    while starts[-1] <= most:
        starts.append(max(starts[-1] + 1, -(-starts[-1] * step // 100)))
    last = np.array(starts[1:], np.int64) - 1
    spoiled = _differ(last + last * 100 // percent, percent)
    return np.array(starts, np.int64), spoiled + 2 + spoiled // 4


def segment_keys(hashes: np.ndarray, sizes: np.ndarray, percent: int, way: int = 1) -> tuple[np.ndarray, np.ndarray]:
    """(keys, counts): under which segments each set is filed, one set after the other. None for a set of size 0.

    `hashes` has the sets one after the other, each sorted. Another `way` cuts other segments.
    """
    of = np.repeat(np.arange(len(sizes)), sizes)
    if way > 1:
        hashes = mixed(hashes ^ _ODD[way % len(_ODD)])
        hashes = hashes[np.lexsort((hashes, of))]
    starts, segments = _ranges(int(sizes.max(initial=0)), percent)
    own = np.searchsorted(starts, sizes, "right") - 1
    below = np.maximum(starts[np.maximum(own, 0)] - 1, 0)
    keys, owners = [], []
    for place, live, spoiled in (
        (own, sizes > 0, _differ(sizes + sizes * 100 // percent, percent)),
        (own - 1, (own > 0) & (-(-sizes * percent // 100) <= below), _differ(sizes + below, percent)),
    ):
        # Sets that cannot differ are equal, and are no two sets.
        live = live & (spoiled > 0)
        taken = live[of]
        held, row = hashes[taken], of[taken]
        if not len(held):
            continue
        segment = (held >> np.uint64(32)) * segments[place[row]].astype(np.uint64) >> np.uint64(32)
        first = np.flatnonzero(np.append(True, (row[1:] != row[:-1]) | (segment[1:] != segment[:-1])))
        count = np.diff(np.append(first, len(held)))
        row, segment = row[first], segment[first]
        base = place.astype(np.uint64) * _ODD[1] + np.uint64(way)
        code = mixed(np.add.reduceat(mixed(held ^ _ODD[2]), first) + mixed(base[row] + segment * _ODD[0])
                     + count.astype(np.uint64))
        order = np.lexsort((code, -count, row))
        row, code = row[order], code[order]
        start = np.searchsorted(row, row)
        kept = np.arange(len(row)) - start <= spoiled[row]
        keys.append(code[kept])
        owners.append(row[kept])
        # Empty segments come last in the order.
        full = np.bincount(row, minlength=len(sizes))
        for at in np.flatnonzero(live & (full <= spoiled)).tolist():
            mine = np.zeros(segments[place[at]], bool)
            mine[segment[order][row == at].astype(np.int64)] = True
            empty = np.sort(mixed(mixed(base[at] + np.flatnonzero(~mine).astype(np.uint64) * _ODD[0])))
            keys.append(empty[:spoiled[at] + 1 - full[at]])
            owners.append(np.full(len(keys[-1]), at))
    if not keys:
        return np.zeros(0, np.uint64), np.zeros(len(sizes), np.int64)
    owner = np.concatenate(owners)
    return np.concatenate(keys)[np.argsort(owner, kind="stable")], np.bincount(owner, minlength=len(sizes))


def _lists(values: np.ndarray, sizes: np.ndarray) -> pa.Array:
    offsets = np.append(0, np.cumsum(sizes)).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values.view(np.int64)))


def filed_documents(docs: DataFrame, ngram: int, percent: int) -> DataFrame:
    """doc_id, n (size of the set), cid (equal for equal sets), row (a hash of the row), keys.

    `keys` are the segments under which the set is filed; of equal sets that a task meets only the first has them.
    """
    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        met: set[int] = set()
        for rows, hashes, sizes in _texts(batches, ngram):
            ids = _ids(hashes, sizes)
            new = np.zeros(len(sizes), bool)
            for at, code in enumerate(ids.tolist()):
                new[at] = code not in met
                met.add(code)
            if len(met) > MET:
                met.clear()
            keys, counts = segment_keys(hashes[np.repeat(new, sizes)], np.where(new, sizes, 0), percent)
            yield pa.RecordBatch.from_arrays([
                rows.column(rows.schema.get_field_index("doc_id")), pa.array(sizes), pa.array(ids.view(np.int64)),
                rows.column(rows.schema.get_field_index("row")), _lists(keys, counts),
            ], ["doc_id", "n", "cid", "row", "keys"])

    schema = StructType([StructField("doc_id", docs.schema["doc_id"].dataType), *[
        StructField(n, LongType()) for n in ("n", "cid", "row")], StructField("keys", ArrayType(LongType()))])
    return docs.mapInArrow(sets, schema)


def filed_sets(found: DataFrame) -> DataFrame:
    """key, cid: the members of all buckets with two different sets; of buckets with the same members one."""
    each = found.select(F.explode("keys").alias("segment"), "cid")
    bucket = Window.partitionBy("segment")
    named = each.select(
        "cid", F.min("cid").over(bucket).alias("low"), F.max("cid").over(bucket).alias("high"),
        F.count(F.lit(1)).over(bucket).alias("members"), F.bit_xor(F.xxhash64("cid")).over(bucket).alias("whole"))
    return named.filter("low <> high").select(F.xxhash64("low", "high", "members", "whole").alias("key"), "cid").distinct()


# --- sets to be compared ----------------------------------------------------

def _bits(hashes: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """Segment and bits of hashes in the filter."""
    first, second = hashes & np.uint64(0xFFFFFF), hashes >> np.uint64(24) & np.uint64(0xFFFFFF) | np.uint64(1)
    places = [(first + np.uint64(j) * second) % np.uint64(SEGMENT_BITS) for j in range(PROBES)]
    return (hashes >> np.uint64(56)).astype(np.int64), [p.astype(np.int64) for p in places]


def hash_filter(hashes: DataFrame) -> np.ndarray:
    """A bit table of fixed size that holds all values of the column; the fuller it is, the more others it lets through."""
    def segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            segment, places = _bits(batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64))
            for s in np.unique(segment).tolist():
                bits = held.setdefault(s, np.zeros(SEGMENT_BITS // 8, np.uint8))
                for p in places:
                    own = p[segment == s]
                    np.bitwise_or.at(bits, own >> 3, (1 << (own & 7)).astype(np.uint8))
        for s, bits in held.items():
            yield pa.RecordBatch.from_arrays([pa.array([s]), pa.array([bits.tobytes()])], ["segment", "bits"])

    (name,) = hashes.columns
    dealt = hashes.repartition(F.shiftrightunsigned(name, 56))
    table = np.zeros((SEGMENTS, SEGMENT_BITS // 8), np.uint8)
    # SEGMENTS rows of a fixed size, whatever the size of the input.
    for row in dealt.mapInArrow(segments, "segment bigint, bits binary").collect():
        table[row["segment"]] |= np.frombuffer(bytes(row["bits"]), np.uint8)
    return table


def _held(table: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    segment, places = _bits(hashes)
    out = np.ones(len(hashes), bool)
    for p in places:
        out &= (table[segment, p >> 3] >> (p & 7).astype(np.uint8) & 1).astype(bool)
    return out


def _sketches(hashes: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """SKETCH bits of each set as rows of 64-bit numbers: the parity of its n-grams at each bit."""
    place = np.repeat(np.arange(len(sizes)), sizes) * SKETCH + (hashes & np.uint64(SKETCH - 1)).astype(np.int64)
    odd = np.bincount(place, minlength=len(sizes) * SKETCH) & 1
    return np.packbits(odd.astype(np.uint8).reshape(-1, SKETCH), axis=1, bitorder="little").view(np.int64)


def compared_sets(docs: DataFrame, table: np.ndarray, ngram: int) -> DataFrame:
    """cid, n, sketch, tokens of the rows whose `row` is in the filter; equal sets may come several times."""
    bits = docs.sparkSession.sparkContext.broadcast(table)

    def wanted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.column(batch.schema.get_field_index("row")).to_numpy(zero_copy_only=False).view(np.uint64)
            held = batch.filter(pa.array(_held(bits.value, rows)))
            if held.num_rows:
                yield held

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, hashes, sizes in _texts(wanted(batches), ngram):
            sketch = _sketches(hashes, sizes)
            yield pa.RecordBatch.from_arrays([
                pa.array(_ids(hashes, sizes).view(np.int64)), pa.array(sizes),
                _lists(sketch.reshape(-1), np.full(len(sizes), SKETCH // 64)), _lists(hashes, sizes),
            ], ["cid", "n", "sketch", "tokens"])

    return docs.mapInArrow(sets, "cid bigint, n bigint, sketch array<bigint>, tokens array<bigint>")


def _filed_again(sets: DataFrame, percent: int, way: int) -> DataFrame:
    """key, cid: the buckets of `sets` (cid, tokens) by segments cut in another way."""
    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tokens = batch.column(batch.schema.get_field_index("tokens"))
            sizes = tokens.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
            found, counts = segment_keys(tokens.flatten().to_numpy(zero_copy_only=False).view(np.uint64), sizes, percent, way)
            yield pa.RecordBatch.from_arrays(
                [batch.column(batch.schema.get_field_index("cid")), _lists(found, counts)], ["cid", "keys"])

    return filed_sets(sets.select("cid", "tokens").mapInArrow(keys, "cid bigint, keys array<bigint>"))


# --- bounds -----------------------------------------------------------------

def _may_link(x: Column, y: Column, percent: int) -> Column:
    """Length filter, and the sketches' lower bound of the n-grams in which two sets differ."""
    length = F.least(x["n"], y["n"]) * 100 >= F.greatest(x["n"], y["n"]) * percent
    apart = F.aggregate(F.zip_with(x["sketch"], y["sketch"], lambda a, b: F.bit_count(a.bitwiseXOR(b))), F.lit(0),
                        lambda s, v: s + v)
    return length & (apart * (100 + percent) <= (x["n"] + y["n"]) * (100 - percent))


# --- links ------------------------------------------------------------------

def _rooted(filed: DataFrame, roots: DataFrame | None) -> DataFrame:
    if roots is None:
        return filed.withColumn("root", F.col("cid"))
    side = roots.select(F.col("node").alias("_node"), F.col("root").alias("_root"))
    return filed.join(side, F.col("cid") == F.col("_node"), "left").withColumn(
        "root", F.coalesce("_root", "cid")).drop("_node", "_root")


@contextmanager
def some_sets(sets: DataFrame, ids: DataFrame) -> Iterator[DataFrame]:
    """`sets` without those whose cid is not in the column `ids`, or nearly all of them, so that these need not be shuffled.

    Holds until the block ends; write what is made of it there.
    """
    ids = ids.distinct()
    if ids.count() <= SENT:
        yield sets.join(F.broadcast(ids), "cid", "left_semi")
        return
    bits = sets.sparkSession.sparkContext.broadcast(hash_filter(ids))

    @F.pandas_udf("boolean")
    def held(cid: pd.Series) -> pd.Series:
        return pd.Series(_held(bits.value, cid.to_numpy().view(np.uint64)))

    try:
        yield sets.filter(held("cid"))
    finally:
        bits.destroy()


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """a, b of the pairs whose sets have enough in common; the pairs of a document with many are dealt out.

    N-grams are shuffled twice: those of each set, and those of one set of each pair.
    """
    # Few documents have more than one piece: at most two for each VERIFIED pairs. Spark sees how few once they are written.
    numbers = materialize(_ends(pairs).groupBy("cid").agg(
        F.ceil(F.count(F.lit(1)) / VERIFIED).cast("int").alias("_pieces")).filter("_pieces > 1"), "jaccard_pieces")
    pieces = F.coalesce("_pieces", F.lit(1))
    held = sets.join(numbers, "cid", "left").select(
        "cid", F.explode(F.sequence(F.lit(0), pieces - 1)).alias("_piece"), "n", "tokens")
    both = pairs
    for side, other in (("a", "b"), ("b", "a")):
        both = both.join(numbers.withColumnRenamed("cid", side), side, "left").withColumn(
            f"_at_{side}", F.pmod(F.xxhash64(other), pieces).cast("int")).drop("_pieces")
    for side in ("a", "b"):
        both = both.join(held.toDF(side, f"_at_{side}", f"n_{side}", f"tokens_{side}"), [side, f"_at_{side}"])
    both = both.withColumn("_shared", F.size(F.array_intersect("tokens_a", "tokens_b")))
    enough = F.col("_shared") * 100 >= (F.col("n_a") + F.col("n_b") - F.col("_shared")) * percent
    return both.filter(enough).select("a", "b")


def _ends(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.explode(F.array("a", "b")).alias("cid"))


def linked_roots(filed: DataFrame, sets: DataFrame, percent: int = PERCENT, bucket: int = BUCKET) -> DataFrame:
    """node, root: every linked set with the smallest one of its component.

    `filed` (key, cid) are the buckets, `sets` (cid, n, sketch, tokens) has each set once; both are written tables.
    """
    spark = filed.sparkSession
    links = spark.createDataFrame([], "a bigint, b bigint")
    slim = sets.select("cid", "n", "sketch")
    tested, roots, depth = links, None, 1

    def check(candidates: DataFrame) -> bool:
        """Verify the pairs that were not verified before; whether there are new links, which are then in `roots`."""
        nonlocal tested, roots
        pairs = materialize(candidates.distinct().join(tested, ["a", "b"], "left_anti"), "jaccard_pairs")
        if not pairs.head(1):
            return False
        tested = tested.unionByName(pairs)
        with some_sets(sets, _ends(pairs)) as own:
            found = materialize(verified(pairs, own, percent), "jaccard_links")
        if not found.head(1):
            return False
        known = links if roots is None else roots.select(F.col("root").alias("a"), F.col("node").alias("b"))
        roots = _components(materialize(known.unionByName(found), "jaccard_edges"))
        return True

    def rooted(rows: DataFrame) -> DataFrame:
        return materialize(_rooted(rows, roots), "jaccard_filed")

    def buckets(rows: DataFrame, turn: int) -> DataFrame:
        """Buckets with several components: members, main (the largest component), minors (members outside of it), hub
        (a member, another one in each turn but the same in most buckets of a group)."""
        order = F.xxhash64("cid", F.lit(turn))
        each = rows.groupBy("key", "root").agg(
            F.count(F.lit(1)).alias("n"), F.min_by("cid", order).alias("m"), F.min(order).alias("o"))
        return materialize(each.groupBy("key").agg(
            F.sum("n").alias("members"), (F.sum("n") - F.max("n")).alias("minors"), F.max_by("root", "n").alias("main"),
            F.min_by(F.struct(F.col("m").alias("cid"), "root"), "o").alias("hub"), F.count(F.lit(1)).alias("_roots"),
        ).filter("_roots > 1").drop("_roots"), "jaccard_buckets")

    me, hub = F.struct("cid", "root", "n", "sketch"), F.col("hub")
    while True:
        filed = rooted(filed)
        open_ = buckets(filed, 0)
        for turn in range(1, ROUNDS + 1):
            met = attach(filed, open_, ["key"], "members").filter(hub["root"] != F.col("root"))
            met = met.select(_pair(F.col("cid"), hub["cid"]).alias("p")).select("p.a", "p.b").distinct()
            if not check(_near(met, slim, percent)):
                break
            # What is linked as a whole is done with.
            filed = rooted(attach(filed, open_, ["key"], "members").select("key", "cid"))
            open_ = buckets(filed, turn)
            if not open_.filter(F.col("minors") > bucket).head(1):
                break
        few = open_.filter(F.col("minors") <= bucket).drop("hub")
        inside = materialize(attach(filed, few, ["key"], "members").join(slim, "cid"), "jaccard_inside")
        outside = inside.filter("root <> main").groupBy("key").agg(F.collect_list(me).alias("held"))
        compared = materialize(few.select("key", "members").join(outside, "key"), "jaccard_outside")
        others = F.filter("held", lambda y: (y["root"] != F.col("root")) & _may_link(me, y, percent))
        check(attach(inside.drop("members", "main", "minors"), compared, ["key"], "members").select(F.explode(
            F.transform(others, lambda y: _pair(F.col("cid"), y["cid"]))).alias("p")).select("p.a", "p.b"))
        crowded = open_.filter(F.col("minors") > bucket).select("key", "members")
        if not crowded.head(1):
            break
        rest = attach(filed, crowded, ["key"], "members")
        if depth == DEEPEST:
            check(_in_blocks(rest.join(slim, "cid"), bucket, percent))
            break
        depth += 1
        again = rest.select("cid").distinct()
        with some_sets(sets, again) as own:
            filed = materialize(_filed_again(own.join(again, "cid", "left_semi"), percent, depth), "jaccard_filed_again")
    return links.toDF("node", "root") if roots is None else roots


def _near(pairs: DataFrame, slim: DataFrame, percent: int) -> DataFrame:
    """a, b of the pairs that pass the filters; `slim` has cid, n, sketch."""
    for side in ("a", "b"):
        own = slim.select(F.col("cid").alias(f"_id_{side}"), F.struct("n", "sketch").alias(f"_{side}"))
        pairs = pairs.join(own, pairs[side] == own[f"_id_{side}"])
    return pairs.filter(_may_link(F.col("_a"), F.col("_b"), percent)).select("a", "b")


def _components(edges: DataFrame) -> DataFrame:
    """node, root as of `components`; at most FEW edges are joined in one task, which saves the rounds."""
    if edges.count() > FEW:
        return components(edges)

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        up: dict[int, int] = {}

        def root(x: int) -> int:
            while up[x] != x:
                up[x] = x = up[up[x]]
            return x

        for batch in batches:
            for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                up.setdefault(a, a)
                up.setdefault(b, b)
                x, y = root(a), root(b)
                up[max(x, y)] = min(x, y)
        found = [(x, root(x)) for x in up]
        yield pa.RecordBatch.from_arrays([pa.array([x for x, r in found if x != r], pa.int64()),
                                          pa.array([r for x, r in found if x != r], pa.int64())], ["node", "root"])

    return materialize(edges.select("a", "b").coalesce(1).mapInArrow(joined, "node bigint, root bigint"), "jaccard_roots")


def _pair(x: Column, y: Column) -> Column:
    return F.struct(F.least(x, y).alias("a"), F.greatest(x, y).alias("b"))


def _in_blocks(rows: DataFrame, bucket: int, percent: int) -> DataFrame:
    """a, b: the pairs of crowded buckets (key, members) that pass the filters, block by block of about `bucket`."""
    blocks = F.ceil(F.col("members") / bucket).cast("int")
    cut = rows.withColumn("block", F.pmod(F.xxhash64("cid"), blocks).cast("int")).withColumn(
        "other", F.explode(F.sequence(F.lit(0), blocks - 1)))
    member = F.struct("cid", "n", "sketch", "root", "block")
    met = cut.groupBy("key", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high")).agg(
        F.collect_list(member).alias("held"))

    def partners(x: Column) -> Column:
        across = F.col("low") == F.col("high")
        others = F.filter("held", lambda y: (y["cid"] > x["cid"]) & (y["root"] != x["root"])
                          & (across | (y["block"] != x["block"])) & _may_link(x, y, percent))
        return F.transform(others, lambda y: _pair(x["cid"], y["cid"]))

    return met.select(F.explode(F.flatten(F.transform("held", partners))).alias("p")).select("p.a", "p.b")


def component_table(docs: DataFrame, ngram: int = SHINGLE, percent: int = PERCENT, bucket: int = BUCKET) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id (the smallest doc_id reachable by links).

    Null texts and texts without words have no n-grams and no links. Repeated rows stay and are linked; a null doc_id
    is never the smallest (a component of nulls has a null). Other columns are ignored. No rows for an empty table.
    """
    slim = docs.select("doc_id", "text", F.xxhash64("doc_id", "text").alias("row"))
    found = materialize(filed_documents(slim, ngram, percent), "jaccard_documents")
    live = found.filter("n > 0")
    classes = materialize(live.groupBy("cid").agg(
        F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("copies"), F.min("row").alias("row")), "jaccard_classes")
    filed = materialize(filed_sets(found), "jaccard_buckets")
    # The sets that meet others are computed again, one row of each, instead of being kept for all documents.
    meeting = filed.select("cid").distinct()
    table = hash_filter(classes.join(meeting, "cid", "left_semi").select("row"))
    again = compared_sets(slim.select("text", "row"), table, ngram)
    sets = materialize(again.join(meeting, "cid", "left_semi").dropDuplicates(["cid"]), "jaccard_sets")
    roots = linked_roots(filed, sets, percent, bucket)
    rooted = materialize(_rooted(classes, roots), "jaccard_rooted")
    each = materialize(rooted.groupBy("root").agg(F.min("least").alias("component_id"),
                                                  F.count(F.lit(1)).alias("members")), "jaccard_components")
    whole = materialize(attach(rooted, each, ["root"], "members").select("cid", "copies", "component_id"), "jaccard_groups")
    linked = attach(live.select("doc_id", "n", "cid"), whole, ["cid"], "copies").select(
        "doc_id", F.col("n").alias("n_shingles"), "component_id")
    alone = found.filter("n = 0").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"))
    return linked.unionByName(alone)
