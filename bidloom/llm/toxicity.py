"""Toxicity: a bidirectional gated recurrent network with attention pooling, trained and run in numpy.

A word's input is the sum of a word embedding and the mean embedding of its character n-grams. Two gated recurrent
layers read a window of words forward and backward, attention pools their states, and a logistic unit scores the
window. A document's score is that of its worst window; windows overlap, and all windows of the whole text count.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bidloom.llm.common import as_text

# Words of a window, and words between the starts of two windows.
WIDTH = 32
STRIDE = 24
# Rows of the word and n-gram embeddings (chosen by a hash), their size, and units of each direction.
WORD_ROWS = 1 << 15
CHAR_ROWS = 1 << 13
# Lengths of character n-grams, in bytes.
GRAMS = (3,)
EMBEDDING = 12
UNITS = 8
# Learning: documents of either label and the bytes of their texts together, rounds, and the steps of a round.
DOCUMENTS = 1500
SAMPLE_BYTES = 8 << 20
ROUNDS = 3
STEPS = 160
MINIBATCH = 192
RATE = 0.01
# Words in fewer learned documents than COMMON are known by their n-grams alone, and so is the share DROPPED of the
# others in a step: what one document has cannot be learned by heart, and words never met are read as well.
COMMON, DROPPED = 5, 0.5
# What the running mean of the parameters keeps in a step.
AVERAGED = 0.98
# Windows scored at once, and words whose inputs a task remembers.
BATCH = 2048
REMEMBERED = 100_000
THRESHOLD = 0.3

_LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
# Everything in ASCII but letters and digits separates words.
_BREAK = bytes(32 if not (48 <= b <= 57 or 97 <= b <= 122 or b >= 128) else b for b in _LOWER)


def split(text: str | None) -> list[bytes]:
    """Words of a text: runs of ASCII letters, digits and all other signs beyond ASCII, A-Z in lower case."""
    return (text or "").encode("utf-8", "replace").translate(_BREAK).split()


def features(words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Embedding rows of words: the word's, and its character n-grams' (with marked ends) as flat numbers with their
    starts."""
    raw = np.frombuffer(b"".join(b"\x02" + w + b"\x03" for w in words), np.uint8).astype(np.uint64)
    lengths = np.fromiter(map(len, words), np.int64, len(words)) + 2
    starts = np.concatenate(([0], np.cumsum(lengths)[:-1]))
    owner = np.repeat(np.arange(len(words)), lengths)
    place = np.arange(len(raw)) - starts[owner]
    # A word's hash: its bytes as digits of a number, modulo 2^64.
    factors = np.full(int(lengths.max()), 0x9E3779B97F4A7C15, np.uint64)
    factors[0] = 1
    power = np.cumprod(factors)
    whole = np.add.reduceat(raw * power[place], starts)
    whole = (whole ^ (whole >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    parts, owners = [], []
    for size in GRAMS:
        many = max(len(raw) - size + 1, 0)
        gram = np.full(many, size, np.uint64)
        for k in range(size):
            gram = gram * np.uint64(0x100000001B3) + raw[k:k + many]
        inside = owner[:many] == owner[size - 1:]
        gram = gram[inside] * np.uint64(0x9E3779B97F4A7C15)
        parts.append((gram >> np.uint64(24)) % np.uint64(CHAR_ROWS))
        owners.append(owner[:many][inside])
    order = np.argsort(np.concatenate(owners), kind="stable")
    grams = np.concatenate(parts)[order].astype(np.int64)
    counts = np.bincount(np.concatenate(owners), minlength=len(words))
    return ((whole >> np.uint64(40)) % np.uint64(WORD_ROWS)).astype(np.int64), grams, np.concatenate(([0], np.cumsum(counts)[:-1]))


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1.0 + np.tanh(0.5 * x))


@dataclass
class Network:
    """Parameters by name. Gates stand in the order update, reset, candidate."""

    p: dict[str, np.ndarray] = field(default_factory=dict)

    @staticmethod
    def fresh(seed: int = 7) -> Network:
        rng = np.random.default_rng(seed)
        scale = lambda *shape, s: (rng.standard_normal(shape) * s).astype(np.float32)
        # Words that learning never met add nothing: their n-grams speak for them.
        p = {"word": np.zeros((WORD_ROWS, EMBEDDING), np.float32), "char": scale(CHAR_ROWS, EMBEDDING, s=0.1)}
        for side in "fb":
            p["w" + side] = scale(EMBEDDING, 3 * UNITS, s=0.3)
            p["u" + side] = scale(UNITS, 3 * UNITS, s=0.3)
            p["c" + side] = np.zeros(3 * UNITS, np.float32)
        p["attend"] = scale(2 * UNITS, s=0.3)
        p["out"] = scale(2 * UNITS, s=0.3)
        p["bias"] = np.zeros(1, np.float32)
        return Network(p)

    def inputs(self, words: list[bytes]) -> np.ndarray:
        """Gate inputs of both directions for each word."""
        word, tri, starts = features(words)
        counts = np.diff(np.concatenate((starts, [len(tri)])))[:, None].astype(np.float32)
        x = self.p["word"][word] + np.add.reduceat(self.p["char"][tri], starts, axis=0) / counts
        return np.concatenate([x @ self.p["w" + s] + self.p["c" + s] for s in "fb"], axis=1)

    def run(self, gates: np.ndarray, mask: np.ndarray, keep: bool = False):
        """Logits of windows: gates (time, window, 6 * UNITS), mask (time, window). `keep`: also what backward needs."""
        time, count, _ = gates.shape
        states, tape = np.zeros((time, count, 2 * UNITS), np.float32), {"f": [], "b": []}
        for side, order, at in (("f", range(time), 0), ("b", range(time - 1, -1, -1), 1)):
            u, h = self.p["u" + side], np.zeros((count, UNITS), np.float32)
            for t in order:
                g = gates[t, :, at * 3 * UNITS:(at + 1) * 3 * UNITS]
                hu = h @ u[:, :2 * UNITS]
                zr = _sigmoid(g[:, :2 * UNITS] + hu)
                z, r = zr[:, :UNITS], zr[:, UNITS:]
                n = np.tanh(g[:, 2 * UNITS:] + (r * h) @ u[:, 2 * UNITS:])
                m = mask[t][:, None]
                new = h + m * (1 - z) * (n - h)
                if keep:
                    tape[side].append((t, h, z, r, n, m))
                states[t, :, at * UNITS:(at + 1) * UNITS] = h = new
        energy = np.where(mask > 0, states @ self.p["attend"], -1e9)
        energy = np.exp(energy - energy.max(axis=0))
        share = energy / energy.sum(axis=0)
        pooled = np.einsum("tb,tbk->bk", share, states)
        logit = pooled @ self.p["out"] + self.p["bias"][0]
        return (logit, states, share, pooled, tape) if keep else logit

    def gradients(self, word, tri, starts, index, mask, target, kept=1.0) -> tuple[dict[str, np.ndarray], float]:
        """Gradients of the mean cross-entropy. Distinct words (features) and `index` (time, window) into them; `kept`
        weighs the word embeddings, 0 for those that are left out of this step."""
        p = self.p
        counts = np.diff(np.concatenate((starts, [len(tri)])))[:, None].astype(np.float32)
        kept = np.broadcast_to(np.asarray(kept, np.float32), len(word))[:, None]
        x = p["word"][word] * kept + np.add.reduceat(p["char"][tri], starts, axis=0) / counts
        per_word = np.concatenate([x @ p["w" + s] + p["c" + s] for s in "fb"], axis=1)
        logit, states, share, pooled, tape = self.run(per_word[index], mask, keep=True)
        chance = _sigmoid(logit)
        loss = float(-np.mean(np.log(np.where(target > 0, chance, 1 - chance) + 1e-7)))
        d_logit = (chance - target) / len(target)
        g = {"out": pooled.T @ d_logit, "bias": np.array([d_logit.sum()], np.float32)}
        d_pooled = d_logit[:, None] * p["out"]
        d_share = np.einsum("bk,tbk->tb", d_pooled, states)
        d_energy = share * (d_share - (share * d_share).sum(axis=0))
        g["attend"] = np.einsum("tb,tbk->k", d_energy, states)
        d_states = share[:, :, None] * d_pooled + d_energy[:, :, None] * p["attend"]
        d_gates = np.zeros((*index.shape, 6 * UNITS), np.float32)
        for side, at in (("f", 0), ("b", 1)):
            u = p["u" + side]
            d_u, d_h = np.zeros_like(u), np.zeros((index.shape[1], UNITS), np.float32)
            for t, h, z, r, n, m in reversed(tape[side]):
                d_new = d_h + d_states[t, :, at * UNITS:(at + 1) * UNITS]
                d_n = d_new * m * (1 - z) * (1 - n * n)
                d_z = -d_new * m * (n - h) * z * (1 - z)
                d_rh = d_n @ u[:, 2 * UNITS:].T
                d_r = d_rh * h * r * (1 - r)
                d_zr = np.concatenate((d_z, d_r), axis=1)
                d_u[:, :2 * UNITS] += h.T @ d_zr
                d_u[:, 2 * UNITS:] += (r * h).T @ d_n
                d_gates[t, :, at * 3 * UNITS:(at + 1) * 3 * UNITS] = np.concatenate((d_zr, d_n), axis=1)
                d_h = d_new * (1 - m * (1 - z)) + d_rh * r + d_zr @ u[:, :2 * UNITS].T
            g["u" + side] = d_u
        flat = np.zeros((len(word), 6 * UNITS), np.float32)
        np.add.at(flat, index.ravel(), d_gates.reshape(-1, 6 * UNITS))
        d_x = np.zeros_like(x)
        for side, at in (("f", 0), ("b", 1)):
            part = flat[:, at * 3 * UNITS:(at + 1) * 3 * UNITS]
            g["w" + side], g["c" + side] = x.T @ part, part.sum(axis=0)
            d_x += part @ p["w" + side].T
        g["word"], g["char"] = np.zeros_like(p["word"]), np.zeros_like(p["char"])
        np.add.at(g["word"], word, d_x * kept)
        np.add.at(g["char"], tri, np.repeat(d_x / counts, counts[:, 0].astype(int), axis=0))
        return g, loss


class _Adam:
    def __init__(self, network: Network, rate: float = RATE):
        self.network, self.rate, self.t = network, rate, 0
        self.m = {k: np.zeros_like(v) for k, v in network.p.items()}
        self.v = {k: np.zeros_like(v) for k, v in network.p.items()}

    def step(self, gradients: dict[str, np.ndarray]) -> None:
        self.t += 1
        for k, g in gradients.items():
            self.m[k] += 0.1 * (g - self.m[k])
            self.v[k] += 0.001 * (g * g - self.v[k])
            rate = self.rate * np.sqrt(1 - 0.999**self.t) / (1 - 0.9**self.t)
            self.network.p[k] -= (rate * self.m[k] / (np.sqrt(self.v[k]) + 1e-8)).astype(np.float32)


def windows(count: int) -> list[int]:
    """Starts of the windows of a text of `count` words: every word is in one, neighbours overlap."""
    if count <= WIDTH:
        return [0]
    return [*range(0, count - WIDTH, STRIDE), count - WIDTH]


def _layout(texts: list[list[bytes]], known: dict[bytes, int]) -> tuple[np.ndarray, np.ndarray]:
    """index and mask (time, window) of windows; words get the next numbers in `known`."""
    index = np.zeros((WIDTH, len(texts)), np.int64)
    mask = np.zeros((WIDTH, len(texts)), np.float32)
    for j, words in enumerate(texts):
        index[:len(words), j] = [known.setdefault(w, len(known)) for w in words]
        mask[:len(words), j] = 1.0
    return index, mask


def train(documents: list[list[list[bytes]]], labels: list[int], odds: float = 0.5, seed: int = 7) -> Network | None:
    """A network from labelled documents, each a list of windows. None unless both labels occur.

    A toxic document is toxic somewhere. In the first round its window with the word most typical of toxic documents
    stands for it, later the window that the network scores highest. Clean documents give the windows that look worst
    and others at random. A third of a minibatch is toxic; `odds` are those of a toxic document, for which the scores
    are corrected at the end.
    """
    if len(set(labels)) < 2:
        return None
    rng, network = np.random.default_rng(seed), Network.fresh(seed)
    known: dict[bytes, int] = {}
    flat = [w for d in documents for w in d]
    owner = np.repeat(np.arange(len(documents)), [len(d) for d in documents])
    index, mask = _layout(flat, known)
    word, tri, starts = features(list(known))
    ends = np.concatenate((starts[1:], [len(tri)]))
    toxic = np.array(labels)[owner] == 1
    guess, spread = _first_guess(documents, np.array(labels), known, word, tri, starts)
    window_guess = np.where(mask > 0, guess[index], -np.inf).max(axis=0)
    adam, average = _Adam(network), {k: v.copy() for k, v in network.p.items()}
    for _ in range(ROUNDS):
        order = np.lexsort((-window_guess, owner))
        worst = order[np.concatenate(([True], owner[order][1:] != owner[order][:-1]))]
        positive, negative = worst[toxic[worst]], worst[~toxic[worst]]
        others = np.flatnonzero(~toxic)
        for _ in range(STEPS):
            third = MINIBATCH // 3
            chosen = np.concatenate((rng.choice(positive, third), rng.choice(negative, third), rng.choice(others, third)))
            used, local = np.unique(index[:, chosen], return_inverse=True)
            sizes = ends[used] - starts[used]
            local_starts = np.concatenate(([0], np.cumsum(sizes)[:-1]))
            local_tri = tri[np.repeat(starts[used] - local_starts, sizes) + np.arange(sizes.sum())]
            target = (np.arange(len(chosen)) < third).astype(np.float32)
            kept = (rng.random(len(used)) >= DROPPED) & (spread[used] >= COMMON)
            adam.step(network.gradients(word[used], local_tri, local_starts, local.reshape(WIDTH, -1),
                                        mask[:, chosen], target, kept)[0])
            for k, v in network.p.items():
                average[k] += (1 - AVERAGED) * (v - average[k])
        gates = network.inputs(list(known))
        window_guess = np.concatenate([network.run(gates[index[:, i:i + BATCH]], mask[:, i:i + BATCH])
                                       for i in range(0, len(flat), BATCH)])
    # The running mean of the parameters depends less on the last minibatches than the parameters do.
    average["bias"] = average["bias"] + np.float32(np.log(odds / 0.5))
    return Network(average)


def _first_guess(documents, labels, known, word, tri, starts) -> tuple[np.ndarray, np.ndarray]:
    """For each word, the log-odds of toxic documents having it or its most telling n-gram, and its documents."""
    counts = np.zeros((2, len(known)))
    tri_counts = np.zeros((2, CHAR_ROWS))
    ends = np.concatenate((starts[1:], [len(tri)]))
    for windows_, label in zip(documents, labels):
        have = np.unique([known[w] for ws in windows_ for w in ws]).astype(int)
        counts[label, have] += 1
        if len(have):
            tri_counts[label, np.unique(np.concatenate([tri[starts[k]:ends[k]] for k in have]))] += 1
    total = np.bincount(labels, minlength=2)

    def odds(c: np.ndarray) -> np.ndarray:
        share = (c + 0.5) / (total[:, None] + 1.0)
        return np.log(share[1] / (1 - share[1])) - np.log(share[0] / (1 - share[0]))

    return np.maximum(odds(counts), np.maximum.reduceat(odds(tri_counts)[tri], starts)), counts.sum(axis=0)


def training_rows(docs: DataFrame, labels: DataFrame, documents: int = DOCUMENTS, most_bytes: int = SAMPLE_BYTES,
                  seed: int = 7) -> tuple[list[list[list[bytes]]], list[int], float]:
    """A bounded sample of labelled documents, with all windows of all their texts, their labels, and the odds of a
    toxic one among all that are labelled.

    Of each label those with the smallest hash of the doc_id: at most `documents`, and of these the ones whose texts
    have at most `most_bytes` together. A document that does not fit any more is left out as a whole. Ids are compared
    as text; an id that is labelled twice has the larger label, and all texts of an id are its document.
    """
    marked = labels.filter(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull()).groupBy(
        F.col("doc_id").cast("string").alias("wanted")).agg(F.max("toxic").cast("int").alias("toxic"))
    marked = marked.withColumn("rank", F.xxhash64(F.lit(seed), "wanted"))
    counts = {r["toxic"]: r["n"] for r in marked.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    picked = []
    for label, n in sorted(counts.items()):
        # About twice the wanted number by a bound on the hash, then exactly the smallest.
        bound = int(min(1.0, 2.0 * documents / n) * 2.0**64 - 2.0**63)
        some = marked.filter((F.col("toxic") == label) & (F.col("rank") <= F.lit(min(bound, 2**63 - 1))))
        picked += some.orderBy("rank", "wanted").limit(documents).select("wanted", "toxic").collect()

    def rows_of(chosen: list) -> DataFrame:
        text = json.dumps([{"wanted": r["wanted"], "toxic": r["toxic"]} for r in chosen])
        side = docs.sparkSession.range(1).select(
            F.inline(F.from_json(F.lit(text), "array<struct<wanted:string,toxic:int>>")))
        plain = docs.select(F.col("doc_id").cast("string").alias("_id"), F.coalesce("text", F.lit("")).alias("text"))
        return plain.join(F.broadcast(side), F.col("_id") == F.col("wanted"), "inner")

    odds = counts.get(1, 0) / max(counts.get(0, 0), 1)
    if not picked:
        return [], [], odds
    sizes = {r["wanted"]: r["size"] for r in rows_of(picked).groupBy("wanted").agg(
        F.sum(F.octet_length("text")).alias("size")).collect()}
    used, chosen = {label: 0 for label in counts}, []
    for row in picked:
        size = sizes.get(row["wanted"])
        if size is not None and used[row["toxic"]] + size <= most_bytes:
            used[row["toxic"]] += size
            chosen.append(row)

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for doc_id, toxic, body in zip(batch["wanted"], batch["toxic"], batch["text"]):
                words = split(body)
                rows.append((doc_id, toxic, [b" ".join(words[s:s + WIDTH]).decode("utf-8", "replace")
                                             for s in windows(len(words))]))
            yield pd.DataFrame(rows, columns=["wanted", "toxic", "windows"])

    if not chosen:
        return [], [], odds
    found = rows_of(chosen).select("wanted", "toxic", "text").mapInPandas(
        cut, "wanted string, toxic int, windows array<string>").collect()
    texts: dict[str, tuple[int, list[str]]] = {}
    for row in sorted(found, key=lambda r: (r["wanted"], r["windows"])):
        texts.setdefault(row["wanted"], (row["toxic"], []))[1].extend(w for w in row["windows"] if w)
    kept = [(toxic, found) for toxic, found in texts.values() if found]
    return [[w.encode().split() for w in found] for _, found in kept], [toxic for toxic, _ in kept], odds


def scorer(network: Network | None):
    """A function for mapInPandas: the row's columns without text, and score, the chance of its worst window."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known: dict[bytes, int] = {}
        table = np.zeros((1024, 6 * UNITS), np.float32)
        for batch in batches:
            worst = np.full(len(batch), -np.inf, np.float32)
            queue: list[list[bytes]] = []
            owner: list[int] = []

            def drain() -> None:
                nonlocal table, known
                if len(known) > REMEMBERED:
                    known = {}
                before = len(known)
                index, mask = _layout(queue, known)
                if len(known) > before:
                    if len(known) > len(table):
                        table = np.concatenate((table, np.zeros((2 * len(known) - len(table), 6 * UNITS), np.float32)))
                    table[before:len(known)] = network.inputs(list(known)[before:])
                logit = network.run(table[index], mask)
                np.maximum.at(worst, owner, logit)
                queue.clear()
                owner.clear()

            if network is not None:
                for i, text in enumerate(batch["text"]):
                    words = split(text)
                    if words:
                        for start in windows(len(words)):
                            queue.append(words[start:start + WIDTH])
                            owner.append(i)
                            if len(queue) == BATCH:
                                drain()
                if queue:
                    drain()
            yield batch.drop(columns="text").assign(score=_sigmoid(worst.astype(float)))

    return run


def score(docs: DataFrame, network: Network | None, keep: list[str]) -> DataFrame:
    """The columns `keep` and score (0 to 1) of every whole text. Texts without words have score 0, and so has
    everything if the labels taught nothing."""
    fields = docs.select(*keep).schema
    slots = {c: f"c{i}" for i, c in enumerate(keep)}
    # Kept columns travel as text, which no conversion changes.
    plain = docs.select(*[docs[c].cast("string").alias(a) for c, a in slots.items()], docs["text"])
    schema = ", ".join(f"{a} string" for a in slots.values()) + ", score double"
    out = plain.mapInPandas(scorer(network), schema)
    return out.select(*[F.col(a).cast(fields[c].dataType).alias(c) for c, a in slots.items()], "score")


def held_out(doc_id, folds: int = 4, fold: int = 2):
    """Whether the CRC-32 of the id's text (the text 'null' for none) falls into the fold that is not learned from."""
    return F.crc32(F.encode(as_text(doc_id), "UTF-8")) % folds == fold


def toxicity_table(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted. Learns from labels of the other folds.

    Null and empty texts, and texts without words, have score 0. Repeated rows are scored each and alike; other columns
    are ignored; an empty table gives no rows. Without labels of both kinds every score is 0.
    """
    documents, marks, odds = training_rows(docs, labels.filter(~held_out(F.col("doc_id"))))
    network = train(documents, marks, odds) if documents else None
    slim = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "text")
    rows = score(slim, network, ["doc_id", "held_out"])
    return rows.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
