"""Benchmark decontamination by template canonicalisation.

Numbers, names and units become typed placeholders, so a question that was asked anew with other values keeps its
windows of canonical words. Windows are joined by hash, and a match counts only if its slots are consistent: within a
passage, equal values of the benchmark item must have become equal values, and different ones different values. Where
two slots of a passage disagree, an unchanged value stands, and the place of the other is one word that is not covered;
of changes that disagree the one in most places stands, and only the windows that hold another are left out. Since
capitals alone tell names, windows in which names are plain words without case are joined as well, so a copy in capitals
or in small letters is found. Windows that are mostly placeholders match only word for word.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bidloom.llm.common import bound_to, fresh
from bidloom.llm.tokens import Words, mixed, words
from bidloom.operators import skew
from bidloom.session import materialize

WINDOW = 8
# Items of fewer words match whole lines only: inside a line such words stand by chance.
SHORTEST = 3
# Share of an item's words that matching windows must cover.
COVERAGE = 0.5
# Bits of the filter that spares the join windows which no benchmark item has: 2 MiB, whatever the tables.
FILTER_BITS = 1 << 24
BITMAP = 32768
# Benchmark windows up to which the join broadcasts them, some 50 MB at most; beyond it the join shuffles.
BROADCAST_ROWS = 200_000
# Unit words after a number.
UNITS = """
mm cm m km in inch inches ft foot feet yd yard yards mile miles mg g kg lb lbs oz ton tons ml l liter liters litre
litres gallon gallons s sec second seconds min minute minutes h hr hour hours day days week weeks month months year
years percent degree degrees dollar dollars euro euros cent cents kb mb gb tb hz khz mhz ghz w kw kwh v mph kmh
""".split()
NUMBER, NAME, UNIT = (np.uint64(k) for k in (0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3))

ROW = "hash bigint, at int, slots array<bigint>"


def _unit_codes() -> np.ndarray:
    return np.sort(next(words([" ".join(UNITS)])).code)


def canonical(found: Words, units: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Canonical codes, and the slot values: a placeholder's own word, 0 elsewhere.

    A number is a word without letters; a unit is a unit word after a number; a name is a capitalised word inside a
    sentence.
    """
    after_number = np.zeros(len(found.code), bool)
    after_number[1:] = found.number[:-1] & (found.doc[1:] == found.doc[:-1])
    unit = after_number & (units[np.minimum(np.searchsorted(units, found.code), len(units) - 1)] == found.code)
    name = found.initial & ~found.after_stop & ~found.number & ~unit
    code = found.code.copy()
    code[found.number], code[unit], code[name] = NUMBER, UNIT, NAME
    return code, np.where(found.number | unit | name, found.code, np.uint64(0))


def _windows(found: Words, lengths: Sequence[int], units: np.ndarray) -> Iterator[tuple]:
    """For each length: hashes, first positions, slots and documents of all windows, in up to two readings of each.

    Windows with names come twice: names are placeholders, or words whose letter case does not matter. A reading of
    which over half the words are placeholders says too little: with the numbers and units alone so many, the window is
    read as plain words; with the names, only the reading without them is left. Equal hashes mean the same reading, so
    all share one index.
    """
    code, slots = canonical(found, units)
    name = code == NAME
    folded, values = np.where(name, found.code, code), np.where(name, np.uint64(0), slots)
    plain = np.where(found.number, found.code, np.uint64(0))
    sums = [np.concatenate(([0], np.cumsum(kind))) for kind in (name, slots != 0, values != 0)]
    line_first = np.append(True, (found.line[1:] != found.line[:-1]) | (found.doc[1:] != found.doc[:-1]))[:len(code)]
    line_last = np.append(line_first[1:], True)[:len(code)]
    start_of = np.flatnonzero(np.concatenate(([True], found.doc[1:] != found.doc[:-1]))) if len(code) else np.zeros(0, int)
    position = np.arange(len(code)) - np.repeat(start_of, np.diff(np.concatenate((start_of, [len(code)]))))
    for length in lengths:
        n = len(code) - length + 1
        if n <= 0:
            continue
        inside = found.doc[length - 1:] == found.doc[:n]
        names, placed, numeric = (total[length:] - total[:n] for total in sums)
        readings = ((code, slots, 2 * placed <= length), (folded, values, (names > 0) & (2 * numeric <= length)),
                    (found.code, plain, 2 * numeric > length))
        if length < SHORTEST:
            readings = ((found.code, plain, line_first[:n] & line_last[length - 1:]),)
        for codes, own, fits in readings:
            hashes = np.full(n, length, np.uint64)
            for j in range(length):
                hashes = hashes * np.uint64(0xD1342543DE82EF95) + codes[j:j + n]
            yield mixed(hashes), position[:n], own, found.doc[:n], np.flatnonzero(inside & fits), length


def _slot_rows(slots: np.ndarray, at: np.ndarray, length: int) -> list[list[int]]:
    signed = slots.view(np.int64)
    return signed[at[:, None] + np.arange(length)].tolist()


def _scan(keys: Sequence[str], lengths: Sequence[int], allowed: np.ndarray | None):
    """A function for mapInPandas: the windows of `text` that pass the filter, with the row's keys."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        units = _unit_codes()
        for batch in batches:
            for found in words(batch["text"]):
                for hashes, position, slots, doc, at, length in _windows(found, lengths, units):
                    if allowed is not None:
                        bit = (hashes[at] % np.uint64(FILTER_BITS)).astype(np.int64)
                        at = at[(allowed[bit >> 3] >> (bit & 7).astype(np.uint8) & 1).astype(bool)]
                    if len(at):
                        out = batch.iloc[doc[at]][list(keys)].reset_index(drop=True)
                        yield out.assign(hash=hashes[at].view(np.int64), at=position[at].astype(np.int32),
                                         slots=_slot_rows(slots, at, length))

    return run


def _lengths(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for found in words(batch["text"]):
            numbers, counts = np.unique(found.doc, return_counts=True)
            yield batch.iloc[numbers][["item", "version"]].reset_index(drop=True).assign(n=counts)


def _bitmap(index: DataFrame) -> np.ndarray:
    """Which remainders of a hash occur: at most FILTER_BITS / BITMAP rows of 4 KiB come to the driver."""
    value = F.pmod(F.conv(F.hex("hash"), 16, 10).cast("decimal(20,0)"), F.lit(FILTER_BITS)).cast("bigint") + 1
    rows = index.select(value.alias("v")).groupBy(F.bitmap_bucket_number("v").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("v")).alias("bits")).collect()
    out = np.zeros(FILTER_BITS // 8, np.uint8)
    for row in rows:
        at = (row["bucket"] - 1) * BITMAP // 8
        out[at:at + BITMAP // 8] = np.frombuffer(row["bits"], np.uint8)
    return out


def _values_of(slots: Column) -> Column:
    """Slots (place, item_slots, slots) without their places."""
    return F.transform(slots, lambda s: F.struct(s["item_slots"].alias("item_slots"), s["slots"].alias("slots")))


def _disagreeing(slots: Column) -> Column:
    """The changes of a run that do not stand, where equal values became different ones or different ones equal:
    `edits` disagree with an unchanged value, `wrong` with another change in as many places."""
    def opposed(x: Column, others: Column, least: bool) -> Column:
        return F.exists(others, lambda o: ((o["item_slots"] == x["item_slots"]) != (o["slots"] == x["slots"])) & (
            o["n"] >= x["n"] if least else F.lit(True)))

    def judged(values: Column) -> Column:
        same = F.filter(values, lambda v: v["item_slots"] == v["slots"])
        changed = F.filter(values, lambda v: v["item_slots"] != v["slots"])
        edits = F.filter(changed, lambda x: opposed(x, same, False))
        rest = F.transform(F.filter(changed, lambda x: ~opposed(x, same, False)), lambda v: F.struct(
            v["item_slots"].alias("item_slots"), v["slots"].alias("slots"), F.size(F.filter(slots, lambda s: (
                s["item_slots"] == v["item_slots"]) & (s["slots"] == v["slots"]))).alias("n")))
        wrong = bound_to(rest, lambda all_: _values_of(F.filter(all_, lambda x: opposed(x, all_, True))))
        distinct = lambda field: F.size(F.array_distinct(values[field]))
        agree = (distinct("item_slots") == F.size(values)) & (distinct("slots") == F.size(values))
        none = F.slice(values, 1, 0)
        return F.when(agree, F.struct(none.alias("edits"), none.alias("wrong"))).otherwise(
            F.struct(edits.alias("edits"), wrong.alias("wrong")))

    return bound_to(F.array_distinct(_values_of(slots)), judged)


def leaks(docs: DataFrame, benchmark: DataFrame, keys: Sequence[str], coverage: float = COVERAGE,
          window: int = WINDOW) -> DataFrame:
    """One row per pair of a document (its `keys`) and a benchmark item that it contains: keys, item_id, coverage,
    n_slots, verbatim (no slot has another value, in windows left out neither).

    Every window of every text is looked up. Null and empty texts match nothing; items shorter than the window match
    as a whole, items of one or two words only as whole lines. Repeated rows and items give one row for each pair of
    different keys; of several texts of one item_id the most covered one counts. Empty tables give no rows.
    """
    names = {k: f"k{i}" for i, k in enumerate(keys)}
    types = dict(docs.dtypes)
    # Keys travel as text: a number that may be null would become a double in Python.
    plain = docs.select(*[docs[k].cast("string").alias(n) for k, n in names.items()], docs["text"])
    # Different texts of one item_id are searched each by itself.
    version = F.concat_ws("-", F.hex(F.xxhash64(benchmark["text"])), F.hex(F.xxhash64(F.lit("text"), benchmark["text"])))
    items = benchmark.select(benchmark["item_id"].cast("string").alias("item"), version.alias("version"), benchmark["text"])
    counts = materialize(items.mapInPandas(_lengths, "item string, version string, n int"), "leak_items")
    sizes = counts.select(F.least("n", F.lit(window)).alias("n")).distinct()
    lengths = sorted(r["n"] for r in sizes.collect())
    index = items.mapInPandas(_scan(["item", "version"], lengths, None), f"item string, version string, {ROW}")
    # A shorter length is for the items that are as short; the others are searched by whole windows.
    least = counts.distinct().withColumnsRenamed({"item": "_item", "version": "_version", "n": "words"})
    same = index["item"].eqNullSafe(least["_item"]) & (index["version"] == least["_version"])
    index = index.join(least, same, "inner").drop("_item", "_version")
    index = index.filter(F.size("slots") == F.least("words", F.lit(window)))
    index = materialize(index.select("item", "version", "words", F.col("hash").alias("h"), F.col("at").alias("item_at"),
                                     F.col("slots").alias("item_slots")).distinct(), "leak_index")
    allowed = _bitmap(index.select(F.col("h").alias("hash")))
    schema = ", ".join(f"{n} string" for n in names.values()) + f", {ROW}"
    seen = plain.mapInPandas(_scan(list(names.values()), lengths, allowed), schema)
    alike = F.size("slots") == F.size("item_slots")
    if index.count() <= BROADCAST_ROWS:
        pairs = seen.join(F.broadcast(index), seen["hash"] == index["h"], "inner").filter(alike)
    else:
        # A window that very many documents have is dealt out.
        seen = materialize(seen, "leak_windows")
        hot = skew.find(seen, {"window": ["hash"]})["window"]
        pairs = skew.left_join(seen, index, [("hash", "h")], hot, [*names.values(), "at"]).filter(
            F.col("h").isNotNull() & alike)
    places = F.sequence(F.col("item_at"), F.col("item_at") + F.size("slots") - 1)
    zipped = F.arrays_zip(places.alias("place"), F.col("item_slots"), F.col("slots"))
    changes = F.filter(zipped, lambda p: p["item_slots"] != 0)
    pairs = pairs.withColumn("changes", changes)
    run = [*names.values(), "item", "version", "words", (F.col("at") - F.col("item_at")).alias("shift"),
           F.size("slots").alias("width")]
    # A run has at most two rows per window of its item, so what is gathered is bounded by the item.
    runs = pairs.groupBy(*run).agg(F.collect_set(F.struct("item_at", "changes")).alias("windows"),
                                   F.array_distinct(F.flatten(F.collect_set("changes"))).alias("slots"))
    runs = runs.withColumn("judged", _disagreeing(F.col("slots")))
    among = lambda field, c: F.exists(F.col("judged")[field], lambda x: (
        x["item_slots"] == c["item_slots"]) & (x["slots"] == c["slots"]))
    right = F.filter("windows", lambda w: ~F.exists(w["changes"], lambda c: among("wrong", c)))
    runs = runs.withColumn("windows", right).filter(F.size("windows") > 0)
    edited = F.transform(F.filter("slots", lambda s: among("edits", s)), lambda s: s["place"])
    spans = F.flatten(F.transform("windows", lambda w: F.sequence(w["item_at"], w["item_at"] + F.col("width") - 1)))
    changed = F.exists("slots", lambda s: s["item_slots"] != s["slots"])
    counted = F.array_distinct(F.flatten(F.transform("windows", lambda w: _values_of(w["changes"]))))
    by_item = runs.groupBy(*names.values(), "item", "version", "words").agg(
        F.array_distinct(F.flatten(F.collect_set(F.array_except(spans, edited)))).alias("covered"),
        F.max(F.size(counted)).alias("n_slots"), (~F.max(changed)).alias("verbatim"))
    by_item = by_item.withColumn("coverage", F.size("covered") / F.col("words"))
    kept = by_item.filter(F.col("coverage") >= coverage).groupBy(*names.values(), "item").agg(
        F.max(F.struct("coverage", "n_slots", "verbatim")).alias("best")).select(*names.values(), "item", "best.*")
    return kept.select(*[F.col(n).cast(types[k]).alias(k) for k, n in names.items()],
                       F.col("item").cast(dict(benchmark.dtypes)["item_id"]).alias("item_id"),
                       "coverage", F.col("n_slots").cast("bigint").alias("n_slots"), "verbatim")


def leak_table(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, item_id, coverage, n_slots, verbatim: one row per contaminated document and the item it contains."""
    return leaks(docs.select("doc_id", "text"), benchmark.select("item_id", "text"), ["doc_id"])


def clean_documents(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that contain no benchmark item, with their columns.

    What a document contains depends on its text alone, so the text's hash decides: rows without doc_id, repeated ones
    and copies are judged like any other.
    """
    key = fresh(docs.columns, "_text_key")
    text_key = F.concat_ws("-", F.hex(F.xxhash64("text")), F.hex(F.xxhash64(F.lit("text"), "text")))
    keyed = docs.withColumn(key, text_key)
    found = leaks(keyed.select(F.col(key).alias("text_key"), "text"), benchmark.select("item_id", "text"), ["text_key"])
    bad = materialize(found.select(F.col("text_key").alias(key)).distinct(), "leak_texts")
    return keyed.join(bad, key, "left_anti").drop(key)
