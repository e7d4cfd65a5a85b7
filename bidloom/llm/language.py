"""Language identification with string kernels.

The kernel of two texts is the number of character n-grams (n = 1, 2, 3 together: the blended spectrum) present in
both, divided by the geometric mean of their numbers. A few landmark texts span the Nyström features, one-versus-rest
kernel ridge regression learns a score for each language, and texts are scored in batches: presence matrix times
landmark matrix times coefficients.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from bidloom.llm.common import as_text

SPECTRUM = 3
# N-grams are numbered by a hash.
FEATURES = 1 << 18
# Learning: documents of each language at most, their shortened pieces in code points, landmarks of each language.
DOCUMENTS = 400
PIECES = (30, 80, 250)
LANDMARKS = 32
RIDGE = 1e-3
# Texts of one matrix product.
BATCH = 256
# Code points worked on at once.
STEP = 1 << 18
# Differences of scores are sharpened by this factor before they become shares.
SHARPNESS = 6.0
UNKNOWN = "und"

_STEPS = (np.uint32(0x9E3779B1), np.uint32(0x85EBCA77), np.uint32(0xC2B2AE3D))


def ngrams(text: str, flags: np.ndarray) -> np.ndarray:
    """Numbers of the n-grams that are present, ascending. `flags`: FEATURES zeros, left as they were."""
    codes = np.frombuffer(text.lower().encode("utf-32-le", "replace"), np.uint32)
    for at in range(0, len(codes), STEP):
        part = codes[at:at + STEP + SPECTRUM - 1]
        hashes = np.zeros(len(part), np.uint32)
        for n in range(SPECTRUM):
            size = len(part) - n
            if size <= 0:
                break
            hashes = (hashes[:size] + part[n:]) * _STEPS[n] + np.uint32(n + 1)
            flags[(hashes ^ (hashes >> np.uint32(15))) & np.uint32(FEATURES - 1)] = True
    found = np.flatnonzero(flags)
    flags[found] = False
    return found


@dataclass(frozen=True)
class Model:
    """languages; the features of any landmark; landmarks as a matrix over them with their sizes; coefficients."""

    languages: list[str]
    known: np.ndarray
    landmarks: np.ndarray
    sizes: np.ndarray
    weights: np.ndarray
    bias: np.ndarray

    def kernel(self, sets: list[np.ndarray]) -> np.ndarray:
        """Kernel values of texts (as feature sets) and landmarks."""
        present = np.zeros((len(sets), len(self.known) + 1), np.float32)
        for i, found in enumerate(sets):
            at = np.searchsorted(self.known, found)
            hit = at < len(self.known)
            hit[hit] = self.known[at[hit]] == found[hit]
            present[i, at[hit]] = 1.0
        norm = np.sqrt(np.maximum(1, np.array([len(s) for s in sets]))[:, None] * self.sizes[None, :])
        return (present[:, :-1] @ self.landmarks.T) / norm

    def scores(self, sets: list[np.ndarray]) -> np.ndarray:
        return self.kernel(sets) @ self.weights + self.bias


def _kernel(a: list[np.ndarray], b: list[np.ndarray]) -> np.ndarray:
    known = np.unique(np.concatenate(b)) if b else np.zeros(0, np.int64)
    matrix = np.zeros((len(b), len(known)), np.float32)
    for i, s in enumerate(b):
        matrix[i, np.searchsorted(known, s)] = 1.0
    sizes = np.maximum(1, np.array([len(s) for s in b], float))
    return Model([], known, matrix, sizes, np.zeros(0), np.zeros(0)).kernel(a)


def train(languages: list[str], sets: list[np.ndarray], per_language: int = LANDMARKS, ridge: float = RIDGE) -> Model:
    """Nyström features on the largest-spaced landmarks of each language, then ridge regression on +1 and -1."""
    names = sorted(set(languages))
    owner = np.array([names.index(x) for x in languages])
    chosen: list[int] = []
    for k in range(len(names)):
        own = np.flatnonzero(owner == k)
        by_size = own[np.argsort([len(sets[i]) for i in own], kind="stable")]
        chosen += by_size[np.unique(np.linspace(0, len(own) - 1, min(per_language, len(own))).astype(int))].tolist()
    marks = [sets[i] for i in chosen]
    known = np.unique(np.concatenate(marks))
    matrix = np.zeros((len(marks), len(known)), np.float32)
    for i, s in enumerate(marks):
        matrix[i, np.searchsorted(known, s)] = 1.0
    sizes = np.maximum(1, np.array([len(s) for s in marks], float))
    values, vectors = np.linalg.eigh(_kernel(marks, marks).astype(float))
    large = values > 1e-6 * max(values.max(), 1e-12)
    root = vectors[:, large] / np.sqrt(values[large])
    features = np.concatenate([_kernel(sets[i:i + BATCH], marks) for i in range(0, len(sets), BATCH)]) @ root
    targets = np.where(owner[:, None] == np.arange(len(names))[None, :], 1.0, -1.0)
    # Every language weighs the same, however many documents it has.
    weight = 1.0 / np.bincount(owner, minlength=len(names))[owner]
    weight *= len(weight) / weight.sum()
    centre, middle = np.average(features, axis=0, weights=weight), np.average(targets, axis=0, weights=weight)
    left = (features - centre) * weight[:, None]
    gram = left.T @ (features - centre) + ridge * len(sets) * np.eye(features.shape[1])
    solved = np.linalg.solve(gram, left.T @ (targets - middle))
    return Model(names, known, matrix, sizes, root @ solved, middle - centre @ solved)


def training_sets(docs: DataFrame, documents: int = DOCUMENTS) -> tuple[list[str], list[np.ndarray]]:
    """Feature sets of a bounded sample: of each language, the `documents` whole texts of the smallest hash, and one
    piece of each length of PIECES out of each."""
    rank = F.xxhash64(F.lit("language"), "text")
    slim = docs.filter(F.col("lang").isNotNull() & F.col("text").isNotNull()).select("lang", rank.alias("rank"), "text")
    # Copies share a hash, so hashes are counted, not rows. The share has room for far more than the sketch's 2%.
    counts = slim.groupBy("lang").agg(F.approx_count_distinct("rank", 0.02).alias("n")).collect()
    if not counts:
        return [], []
    # A share of each language's hashes that holds about twice the wanted number; then exactly the smallest ones.
    bound = F.lit(0.0)
    for row in counts:
        share = F.lit(min(1.0, 2.0 * documents / row["n"]))
        bound = F.when(F.col("lang") == row["lang"], share).otherwise(bound)
    low = slim.filter(F.col("rank").cast("double") <= bound * 2.0**64 - 2.0**63)
    few = low.groupBy("lang", "rank").agg(F.count(F.lit(1)).alias("copies"))
    nth = F.row_number().over(Window.partitionBy("lang").orderBy("rank"))
    picked = few.withColumn("nth", nth).filter(F.col("nth") <= documents).select("lang", "rank").collect()
    # Copies of a text are one text.
    chosen = slim.join(F.broadcast(_values(docs, picked)), ["lang", "rank"], "left_semi")
    chosen = chosen.groupBy("lang", "rank").agg(F.first("text").alias("text"))
    rows = chosen.mapInPandas(_features, "lang string, rank bigint, set array<int>").collect()
    rows = sorted(rows, key=lambda r: (r["lang"], r["rank"], len(r["set"]), r["set"]))
    return [r["lang"] for r in rows], [np.array(r["set"], np.int64) for r in rows]


def _values(docs: DataFrame, rows: list) -> DataFrame:
    """The picked (lang, rank) rows as a table; their number is bounded by languages times DOCUMENTS."""
    text = json.dumps([{"lang": r["lang"], "rank": r["rank"]} for r in rows])
    return docs.sparkSession.range(1).select(F.inline(F.from_json(F.lit(text), "array<struct<lang:string,rank:bigint>>")))


def _features(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    flags = np.zeros(FEATURES, bool)
    for batch in batches:
        rows = []
        for lang, rank, text in zip(batch["lang"], batch["rank"], batch["text"]):
            spare = np.random.default_rng(abs(int(rank)))
            texts = [text] + [text[at:at + n] for n in PIECES if len(text) > n
                              for at in [int(spare.integers(len(text) - n))]]
            rows += [(lang, rank, ngrams(t, flags).astype(np.int32).tolist()) for t in texts if has_letter(t)]
        yield pd.DataFrame(rows, columns=["lang", "rank", "set"])


def has_letter(text: str) -> bool:
    return any(map(str.isalpha, text))


def predictor(model: Model | None):
    """A function for mapInPandas: adds lang_pred and score to (row columns..., text)."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        flags = np.zeros(FEATURES, bool)
        for batch in batches:
            texts = batch["text"].tolist()
            names, shares = [UNKNOWN] * len(texts), np.zeros(len(texts))
            readable = [i for i, t in enumerate(texts) if model is not None and t is not None and has_letter(t)]
            for at in range(0, len(readable), BATCH):
                part = readable[at:at + BATCH]
                raw = model.scores([ngrams(texts[i], flags) for i in part])
                best = raw.argmax(axis=1)
                top = raw[np.arange(len(part)), best]
                share = 1.0 / np.exp(SHARPNESS * (raw - top[:, None])).sum(axis=1)
                for i, k, s in zip(part, best, share):
                    names[i], shares[i] = model.languages[k], s
            yield batch.drop(columns="text").assign(lang_pred=names, score=shares)

    return run


def predict(docs: DataFrame, model: Model | None, keep: list[str]) -> DataFrame:
    """The columns `keep`, lang_pred and score (0 to 1) of every whole text.

    Null text and text without a letter is 'und' with score 0, as is everything if nothing could be learned.
    """
    fields = docs.select(*keep).schema
    slots = {c: f"c{i}" for i, c in enumerate(keep)}
    # Kept columns travel as text, which no conversion changes.
    plain = docs.select(*[docs[c].cast("string").alias(a) for c, a in slots.items()], docs["text"])
    schema = ", ".join(f"{a} string" for a in slots.values()) + ", lang_pred string, score double"
    out = plain.mapInPandas(predictor(model), schema)
    return out.select(*[F.col(a).cast(fields[c].dataType).alias(c) for c, a in slots.items()], "lang_pred", "score")


def held_out(doc_id, folds: int, fold: int):
    """Whether the CRC-32 of the id's text (the text 'null' for none) falls into the fold that is not learned from."""
    return F.crc32(F.encode(as_text(doc_id), "UTF-8")) % folds == fold


def language_table(docs: DataFrame, folds: int = 3, fold: int = 1) -> DataFrame:
    """One row per document: doc_id, held_out, lang_pred, score. Learns from the text and lang of the other folds."""
    slim = docs.select("doc_id", "text", "lang", held_out(F.col("doc_id"), folds, fold).alias("held_out"))
    languages, sets = training_sets(slim.filter(~F.col("held_out")))
    model = train(languages, sets) if languages else None
    return predict(slim, model, ["doc_id", "held_out"])
