import numpy as np
import pytest
from pyspark.sql import functions as F

from bidloom.llm import toxicity as tox


def test_gradients():
    rng = np.random.default_rng(0)
    network = tox.Network.fresh(1)
    network.p = {k: v.astype(np.float64) for k, v in network.p.items()}
    words = [bytes(rng.integers(97, 123, 4, dtype=np.uint8)) for _ in range(9)]
    word, tri, starts = tox.features(words)
    index = rng.integers(0, 9, (6, 3))
    mask = np.array([[1, 1, 1]] * 4 + [[1, 0, 1]] * 2, float)
    target = np.array([1.0, 0.0, 1.0])
    gradients, _ = network.gradients(word, tri, starts, index, mask, target)
    for name, at in [("out", 3), ("attend", 5), ("bias", 0), ("uf", (2, 4)), ("ub", (1, 20)), ("wf", (3, 7)), ("cb", 9),
                     ("word", (word[index[0, 0]], 2)), ("char", (tri[starts[index[0, 0]]], 5))]:
        losses = []
        for by in (1e-4, -1e-4):
            network.p[name][at] += by
            losses.append(network.gradients(word, tri, starts, index, mask, target)[1])
            network.p[name][at] -= by
        assert gradients[name][at] == pytest.approx((losses[0] - losses[1]) / 2e-4, rel=0.02, abs=2e-5)


@pytest.mark.parametrize("count", [0, 1, 31, 32, 33, 56, 57, 1000])
def test_windows_cover_and_overlap(count):
    starts = tox.windows(count)
    assert {i for s in starts for i in range(s, min(s + tox.WIDTH, count))} == set(range(count))
    assert all(0 < b - a <= tox.STRIDE for a, b in zip(starts, starts[1:]))


def test_features_do_not_depend_on_the_batch():
    words = [b"idiot", b"a", "élan".encode(), b"x" * 500]
    word, tri, starts = tox.features(words)
    for i, w in enumerate(words):
        alone = tox.features([w])
        assert word[i] == alone[0][0]
        assert (tri[starts[i]:][:len(alone[1])] == alone[1]).all()


def test_long_words_differ():
    """Words with equal starts have rows of their own: the whole word is hashed."""
    words = [b"kill", b"killing", b"killjoy", b"killer", b"international", b"internet", b"internal", b"abcdeXYZ", b"abcdX", b"abcdY"]
    many = [b"international" + str(i).encode() for i in range(2000)]
    assert len(set(tox.features(words)[0].tolist())) == len(words)
    assert len(set(tox.features(many)[0].tolist())) > 1900


def plain_score(network, text):
    """The network, word by word, in plain numpy."""
    p, words, best = {k: v.astype(float) for k, v in network.p.items()}, tox.split(text), None
    for start in tox.windows(len(words)):
        xs = []
        for w in words[start:start + tox.WIDTH]:
            row, tri, _ = tox.features([w])
            xs.append(p["word"][row[0]] + p["char"][tri].mean(axis=0))
        states = []
        for side, order in (("f", range(len(xs))), ("b", range(len(xs) - 1, -1, -1))):
            h, out = np.zeros(tox.UNITS), {}
            for t in order:
                z, r, n = np.split(xs[t] @ p["w" + side] + p["c" + side], 3)
                uz, ur, un = np.split(p["u" + side], 3, axis=1)
                z, r = 1 / (1 + np.exp(-z - h @ uz)), 1 / (1 + np.exp(-r - h @ ur))
                h = z * h + (1 - z) * np.tanh(n + (r * h) @ un)
                out[t] = h
            states.append([out[t] for t in range(len(xs))])
        both = np.concatenate(states, axis=1)
        share = np.exp(both @ p["attend"])
        value = 1 / (1 + np.exp(-(share / share.sum()) @ both @ p["out"] - p["bias"][0]))
        best = value if best is None else max(best, value)
    return 0.0 if not words else best


def test_against_plain_numpy(docs_of):
    rng = np.random.default_rng(3)
    vocabulary = [f"word{i}" for i in range(40)] + ["élan", "ÜBER", "a"]
    texts = [" ".join(rng.choice(vocabulary, n)) for n in (1, 5, 31, 32, 33, 80, 300)]
    network = tox.Network.fresh(4)
    rows = tox.score(docs_of(list(enumerate(texts))), network, ["doc_id"]).collect()
    for row in rows:
        assert row.score == pytest.approx(plain_score(network, texts[row.doc_id]), abs=1e-5)


def test_all_texts_of_an_id_are_learned_from(docs_of, labels_of):
    """In any order of the rows, and whole documents only beyond the bound."""
    long = " ".join(f"w{i}" for i in range(5000))
    rows = [(1, "one text"), (1, "another text"), (2, long), (3, "clean words"), (None, "x"), (4, None)]
    labels = labels_of([(1, 1, 1), (2, 1, 0), (3, 1, 0), (4, 1, 1), (None, 1, 1)])
    first = tox.training_rows(docs_of(rows), labels)
    assert first == tox.training_rows(docs_of(rows[::-1]).repartition(3), labels)
    assert sorted(map(len, first[0])) == [1, 2, len(tox.windows(5000))] and sorted(first[1]) == [0, 0, 1]
    assert sorted(map(len, tox.training_rows(docs_of(rows), labels, most_bytes=100)[0])) == [1, 2]


def test_held_out(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    rows = tox.toxicity_table(docs, labels)
    assert rows.count() == docs.count()
    tested = rows.filter("held_out").join(labels.groupBy("doc_id").agg(F.max("toxic").alias("toxic")), "doc_id").collect()
    found = [r.predicted for r in tested if r.toxic == 1]
    clean = [r.predicted for r in tested if r.toxic == 0]
    assert sum(found) / len(found) > 0.9 and sum(clean) / len(clean) < 0.03


def test_odd_rows(odd_docs, docs_of, labels_of):
    rows = tox.toxicity_table(odd_docs, labels_of([(1, 1, 0), (7, 1, 1), (7, 1, 1), (None, 1, 1), (3, 0, 1), (8, None, None)])).collect()
    assert len(rows) == 11 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)
    assert {r.score for r in rows if r.doc_id in (3, 4, 5)} == {0.0}
    assert {r.score for r in tox.toxicity_table(odd_docs, labels_of([])).collect()} == {0.0}
    assert tox.toxicity_table(docs_of([]), labels_of([(1, 1, 1)])).collect() == []
