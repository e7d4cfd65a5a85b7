import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from bidloom.llm import spelling


def plain_words(rows):
    counts = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(x.lower() if "A" <= x <= "Z" else x for x in run)
            h = zlib.crc32(f"{'null' if doc is None else doc}:{run}".encode())
            if h % 199 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            counts[run] += len(run) >= 6
    return {w: n for w, n in counts.items() if n >= 5}


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def plain_table(rows):
    words = plain_words(rows)
    near = {w: [v for v in words if abs(len(v) - len(w)) < 2 and one_edit(w, v)] for w in words}
    form = {}
    for w, found in near.items():
        best = min(found, key=lambda v: (-words[v], v), default=None)
        form[w] = best if best is not None and words[best] >= 5 * words[w] else None

    def root(w):
        return w if form[w] is None else root(form[w])

    return sorted((w, form[w], root(w), n, len(near[w]), words.get(form[w])) for w, n in words.items())


def run(docs, **search):
    return sorted(tuple(r) for r in spelling.variant_table(docs, **search).collect())


def noisy_docs(seed, stems=60, documents=150):
    """Words that are edited once or twice, frequent and rare, some anagrams of each other."""
    rng = random.Random(seed)
    letters = "abcdeéàÿ÷"
    words = ["".join(rng.choice(letters) for _ in range(rng.randrange(5, 11))) for _ in range(stems)]
    words += ["".join(rng.sample(w, len(w))) for w in words[:20]] + ["ababab", "bababa", "aababab", "abababa"]
    for _ in range(240):
        w = rng.choice(words)
        i = rng.randrange(len(w))
        words.append(rng.choice([w[:i] + rng.choice(letters) + w[i + 1:], w[:i] + w[i + 1:], w[:i] + rng.choice(letters) + w[i:]]))
    weights = [rng.choice([1, 1, 3, 20, 150]) for _ in words]
    return [(i, " ".join(rng.choices(words, weights, k=120)).replace("a", rng.choice("aA"), 9)) for i in range(documents)]


@pytest.mark.parametrize("search", [{}, {"cell": 8, "depth": 4, "sample": 40}, {"cell": 8, "depth": 4, "sample": 2}])
def test_against_all_pairs(docs_of, search):
    rows = noisy_docs(3)
    got = run(docs_of(rows), **search)
    assert got == plain_table(rows)
    assert any(f is not None and r != f for _, f, r, *_ in got) and any(n > 3 for *_, n, _ in got)


def test_given_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    assert run(docs) == plain_table([tuple(r) for r in docs.collect()])


def test_odd_rows(odd_docs):
    rows = [(r.doc_id, r.text) for r in odd_docs.collect()]
    assert run(odd_docs) == plain_table(rows)


def test_long_words_and_many_repeats(docs_of):
    rows = [(i, "x" * 3000 + " " + "x" * 2999 + "y " + "x" * 2999 + " straße Straße strasse " + "é" * 7) for i in range(9)]
    assert run(docs_of(rows)) == plain_table(rows)


def test_empty_table(docs_of):
    assert run(docs_of([])) == [] and run(docs_of([(1, None), (2, "short words only")])) == []


def test_tree_reaches_all_boxes_within_the_distance():
    rng = np.random.default_rng(5)
    vectors = rng.integers(0, 3, (400, spelling.DIMENSIONS)).astype(np.float32) * (rng.random(spelling.DIMENSIONS) < 0.1)
    tree = spelling.Tree(vectors, 8)
    assert sorted(np.concatenate(tree.members).tolist()) == list(range(400))
    for distance in (0, 1, 2):
        reached = {(leaf, q) for leaf, rows in tree.within(vectors, distance) for q in rows.tolist()}
        for leaf, members in enumerate(tree.members):
            apart = np.abs(vectors[:, None] - vectors[members]).sum(axis=2)
            assert {(leaf, q) for q in np.nonzero((apart <= distance).any(axis=1))[0].tolist()} <= reached
        if distance == 0:
            assert len(reached) == 400
