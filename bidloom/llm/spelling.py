"""Spelling variants by k-d trees over letter counts.

One edit changes few letter counts: a replaced letter moves a word's vector by an L1 distance of two within its length,
an inserted or deleted one by a distance of one to the next length. Words of a length are cut into cells by the upper
part of a k-d tree, whose planes are fitted on a bounded sample; every word lies in the one cell of its vector and asks
all cells of its length within distance two, and of the next length within distance one. In a cell the tree goes on
over the different vectors, whole boxes beyond the distance are pruned for all queries at once, and the words of the
vectors that are left are verified by their letter order.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bidloom.llm.common import LOWER, UPPER, as_text, fresh
from bidloom.session import materialize

# Words have this many code points and occurrences at least; a form has FACTOR times the occurrences of its variant.
SHORTEST, LEAST, FACTOR = 6, 5, 5
# One occurrence in FAULT loses a letter before words are counted.
FAULT = 199
# The letters of words once A-Z are lower case.
FIRST_EXTRA, LAST_EXTRA = 0xC0, 0xFF
DIMENSIONS = 26 + LAST_EXTRA - FIRST_EXTRA + 1
# Words of one length in a cell, and the most cells of a length (as a power of two); the planes of a length are fitted
# on about SAMPLE words. More words than that make larger cells: no word is left out.
CELL, DEPTH, SAMPLE = 16_384, 12, 32_768
# Vectors in a leaf of the tree within a cell.
LEAF = 128
_BOTH = "home", "same", "shorter"


# --- words ------------------------------------------------------------------

def word_counts(docs: DataFrame, fault: int = FAULT, shortest: int = SHORTEST, least: int = LEAST) -> DataFrame:
    """word, n: runs of letters of every whole text after the dealt faults, with their occurrences."""
    key = fresh(["run"], "key")
    text = F.translate(F.coalesce("text", F.lit("")), UPPER, LOWER)
    runs = docs.select(as_text(F.col("doc_id")).alias(key), F.explode(F.regexp_extract_all(
        text, F.lit(f"([a-z\\x{{{FIRST_EXTRA:X}}}-\\x{{{LAST_EXTRA:X}}}]+)"), F.lit(1))).alias("run"))
    runs = runs.filter(F.length("run") >= shortest)
    hashed = runs.select("run", F.crc32(F.concat(key, F.lit(":"), F.col("run")).cast("binary")).alias("h"))
    at = (F.col("h") % F.length("run")).cast("int")
    shorter = F.concat(F.substring(F.col("run"), F.lit(1), at), F.substring(F.col("run"), at + 2, F.length("run")))
    words = hashed.select(F.when(F.col("h") % fault == 0, shorter).otherwise(F.col("run")).alias("word"))
    return words.filter(F.length("word") >= shortest).groupBy("word").agg(
        F.count(F.lit(1)).alias("n")).filter(F.col("n") >= least)


def letter_counts(words: list[str]) -> np.ndarray:
    """One row of letter counts for each word."""
    out = np.zeros((len(words), DIMENSIONS), np.float32)
    step = 4096
    for start in range(0, len(words), step):
        part = words[start:start + step]
        codes = np.frombuffer("".join(part).encode("utf-32-le"), np.uint32).astype(np.int64)
        dims = np.where(codes >= FIRST_EXTRA, codes - FIRST_EXTRA + 26, codes - 97)
        of = np.repeat(np.arange(len(part)), [len(w) for w in part])
        counted = np.bincount(of * DIMENSIONS + dims, minlength=len(part) * DIMENSIONS)
        out[start:start + step] = counted.reshape(len(part), DIMENSIONS)
    return out


# --- the tree ---------------------------------------------------------------

class Tree:
    """A k-d tree: inner nodes are (dimension, cut, left, right) with counts up to the cut on the left; leaves are
    numbers."""

    def __init__(self, vectors: np.ndarray, leaf: int, depth: int = 64):
        self.leaves = 0
        self.members: list[np.ndarray] = []
        self.root = self._grow(vectors, np.arange(len(vectors)), leaf, depth)

    def _grow(self, vectors: np.ndarray, rows: np.ndarray, leaf: int, depth: int):
        own = vectors[rows]
        spread = own.var(axis=0) if len(rows) > leaf and depth else np.zeros(1)
        if not spread.max(initial=0.0) > 0:
            self.members.append(rows)
            self.leaves += 1
            return self.leaves - 1
        dimension = int(spread.argmax())
        values = own[:, dimension]
        cut = float(np.floor(np.median(values)))
        if cut >= values.max():
            cut = float(values[values < values.max()].max())
        left = values <= cut
        return (dimension, cut, self._grow(vectors, rows[left], leaf, depth - 1),
                self._grow(vectors, rows[~left], leaf, depth - 1))

    def within(self, queries: np.ndarray, distance: float) -> Iterator[tuple[int, np.ndarray]]:
        """(leaf, queries whose L1 distance to the leaf's box is within `distance`)."""
        def visit(node, rows, gaps, box):
            if not len(rows):
                return
            if not isinstance(node, tuple):
                yield node, rows
                return
            dimension, cut, left, right = node
            low, high = box.get(dimension, (-np.inf, np.inf))
            values = queries[rows, dimension]
            rest = gaps - np.maximum(low - values, 0) - np.maximum(values - high, 0)
            for child, bounds in ((left, (low, min(high, cut))), (right, (max(low, cut + 1), high))):
                wide = rest + np.maximum(bounds[0] - values, 0) + np.maximum(values - bounds[1], 0)
                near = wide <= distance
                yield from visit(child, rows[near], wide[near], {**box, dimension: bounds})

        yield from visit(self.root, np.arange(len(queries)), np.zeros(len(queries), np.float32), {})


def _close(queries: np.ndarray, vectors: np.ndarray, distance: int) -> Iterator[tuple[int, int]]:
    """Pairs (query, vector) at exactly this L1 distance, which for one edit is also their squared distance."""
    tree = Tree(vectors, LEAF)
    exact = np.float64 if max(queries.max(initial=0), vectors.max(initial=0)) > 1000 else np.float32
    queries, vectors = queries.astype(exact), vectors.astype(exact)
    squares, own = (queries**2).sum(axis=1), (vectors**2).sum(axis=1)
    for leaf, rows in tree.within(queries, distance):
        members = tree.members[leaf]
        for start in range(0, len(rows), 4096):
            part = rows[start:start + 4096]
            apart = squares[part, None] + own[members] - 2 * (queries[part] @ vectors[members].T)
            at = np.nonzero(apart == distance)
            yield from zip(part[at[0]].tolist(), members[at[1]].tolist())


def _by_vector(words: list[str]) -> tuple[np.ndarray, list[list[str]]]:
    """The different letter vectors, and the words of each."""
    if not words:
        return np.zeros((0, DIMENSIONS), np.float32), []
    vectors, of = np.unique(letter_counts(words), axis=0, return_inverse=True)
    grouped: list[list[str]] = [[] for _ in range(len(vectors))]
    for word, at in zip(words, of.reshape(-1).tolist()):
        grouped[at].append(word)
    return vectors, grouped


def _letter(dimension: int) -> str:
    return chr(97 + dimension) if dimension < 26 else chr(FIRST_EXTRA + dimension - 26)


def _without(word: str, letter: str) -> Iterator[tuple[str, str]]:
    """(before, after) around every place of the letter in the word."""
    at = word.find(letter)
    while at >= 0:
        yield word[:at], word[at + 1:]
        at = word.find(letter, at + 1)


def near_words(home: list[str], same: list[str], shorter: list[str]) -> tuple[list[tuple[str, str]], list[tuple[str, str]]]:
    """(pairs of a word of `same` and one of `home` with one letter replaced, pairs of a word of `shorter` and one of
    `home` with one letter more)."""
    vectors, words = _by_vector(home)
    known, replaced, inserted = set(home), [], []
    queries, asking = _by_vector(same)
    for q, v in _close(queries, vectors, 2):
        change = vectors[v] - queries[q]
        gone, come = _letter(int(change.argmin())), _letter(int(change.argmax()))
        for word in asking[q]:
            found = {a + come + b for a, b in _without(word, gone)} & known
            replaced += [(word, near) for near in found]
    queries, asking = _by_vector(shorter)
    asked = set(shorter)
    for q, v in _close(queries, vectors, 1):
        come = _letter(int((vectors[v] - queries[q]).argmax()))
        for near in words[v]:
            inserted += [(word, near) for word in {a + b for a, b in _without(near, come)} & asked]
    return replaced, inserted


# --- search over the whole vocabulary ---------------------------------------

def _trees(vocabulary: DataFrame, cell: int, depth: int, sample: int) -> dict[int, Tree]:
    """The upper trees of the lengths with more words than a cell takes; there are fewer such lengths than cells."""
    sizes = {r["length"]: r["n"] for r in vocabulary.groupBy(F.length("word").alias("length")).agg(
        F.count(F.lit(1)).alias("n")).filter(F.col("n") > cell).collect()}
    if not sizes:
        return {}
    parts = 1 << 20
    share = F.create_map(*[F.lit(x) for length, n in sizes.items() for x in (length, sample * parts // n + 1)])
    drawn = vocabulary.filter(F.length("word").isin(list(sizes))).filter(
        F.pmod(F.xxhash64("word"), F.lit(parts)) < share[F.length("word")]).select("word").collect()
    words = defaultdict(list)
    for row in sorted(r["word"] for r in drawn):
        words[len(row)].append(row)
    out = {}
    for length, n in sizes.items():
        levels = min(depth, int(np.ceil(np.log2(n / cell))))
        tree = Tree(letter_counts(words[length]), 1, levels)
        tree.members = []
        out[length] = tree
    return out


def near_pairs(vocabulary: DataFrame, cell: int = CELL, depth: int = DEPTH, sample: int = SAMPLE) -> DataFrame:
    """word, near, near_n: every ordered pair of words that differ by one edit. `vocabulary` (word, n) is written."""
    trees = _trees(vocabulary, cell, depth, sample)

    def dealt(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            words, counts = np.array(batch["word"].tolist(), object), batch["n"].to_numpy()
            lengths = np.array([len(w) for w in words], np.int64)
            for length in np.unique(lengths).tolist():
                rows = np.nonzero(lengths == length)[0]
                vectors = letter_counts(words[rows].tolist())
                for kind, target, distance in (("home", length, 0), ("same", length, 2), ("shorter", length + 1, 1)):
                    cells = trees[target].within(vectors, distance) if target in trees else [(0, np.arange(len(rows)))]
                    for number, found in cells:
                        many = np.ones(len(found), np.int64)
                        yield pd.DataFrame({
                            "length": many * target, "cell": many * number, "kind": _texts([kind] * len(found)),
                            "word": _texts(words[rows[found]]), "n": counts[rows[found]]})

    def searched(group: pd.DataFrame) -> pd.DataFrame:
        words = {kind: group.loc[group["kind"] == kind, "word"].tolist() for kind in _BOTH}
        replaced, inserted = near_words(*(words[kind] for kind in _BOTH))
        pairs = replaced + inserted + [(b, a) for a, b in inserted]
        count = dict(zip(group["word"], group["n"]))
        return pd.DataFrame({"word": _texts([a for a, _ in pairs]), "near": _texts([b for _, b in pairs]),
                             "near_n": np.array([count[b] for _, b in pairs], np.int64)})

    cells = vocabulary.select("word", "n").mapInPandas(dealt, "length int, cell int, kind string, word string, n bigint")
    return cells.groupBy("length", "cell").applyInPandas(searched, "word string, near string, near_n bigint")


def _texts(values) -> pd.Series:
    return pd.Series(list(values), dtype=object)


def roots(forms: DataFrame) -> DataFrame:
    """word, root of the words with a form: forms are followed to the last one, twice as far in each round.

    A form has FACTOR times the occurrences of its word, so chains, and with them the rounds, are few.
    """
    state = materialize(forms.select("word", F.col("form").alias("root")), "spelling_roots")
    while True:
        ahead = state.select(F.col("word").alias("_word"), F.col("root").alias("_root"))
        step = state.join(ahead, F.col("root") == F.col("_word"), "left")
        state = materialize(step.select("word", F.coalesce("_root", "root").alias("root"),
                                        F.col("_root").isNotNull().alias("moved")), "spelling_roots")
        if not state.filter("moved").head(1):
            return state.select("word", "root")


def variant_table(docs: DataFrame, factor: int = FACTOR, **search) -> DataFrame:
    """word, form, root, n, n_near, form_n: one row per word of the texts (see `word_counts`).

    Near words differ by one inserted, deleted or replaced code point. The form is the near word with most
    occurrences (ties: the smallest by code point) if it has at least `factor` times the word's; the root follows forms
    to the last. Null texts have no words, a null doc_id is `null` in the hashed text, repeated rows count again, other
    columns are ignored. No rows for an empty table.
    """
    vocabulary = materialize(word_counts(docs), "spelling_words")
    best = near_pairs(vocabulary, **search).groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near"))).alias("best"))
    is_form = -F.col("best.less") >= F.col("n") * factor
    joined = vocabulary.join(best.withColumnRenamed("word", "_word"), F.col("word") == F.col("_word"), "left")
    forms = materialize(joined.select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("bigint")).alias("n_near"),
        F.when(is_form, F.col("best.near")).alias("form"), F.when(is_form, -F.col("best.less")).alias("form_n"),
    ), "spelling_forms")
    ends = roots(forms.filter("form IS NOT NULL")).withColumnRenamed("word", "_word").withColumnRenamed("root", "_root")
    return forms.join(ends, F.col("word") == F.col("_word"), "left").select(
        "word", "form", F.coalesce("_root", "word").alias("root"), "n", "n_near", "form_n")

