from collections import Counter

import numpy as np
import pytest

from bidloom.llm import language as lang

SAMPLES = {
    "en": "the old man walked along the river and thought about his house with the blue door",
    "de": "der alte Mann ging am Fluss entlang und dachte an sein Haus mit der blauen Tür",
    "fr": "le vieil homme marchait le long de la rivière et pensait à sa maison à la porte bleue",
}


def grams(text):
    text = text.lower()
    return {text[i:i + n] for n in (1, 2, 3) for i in range(len(text) - n + 1)}


def test_kernel_is_the_blended_presence_kernel():
    flags = np.zeros(lang.FEATURES, bool)
    texts = list(SAMPLES.values()) + ["", "a", "ab"]
    sets = [lang.ngrams(t, flags) for t in texts]
    assert not flags.any()
    own = [grams(t) for t in texts]
    # Hashing may join a few n-grams.
    assert all(0 <= len(a) - len(b) <= 2 for a, b in zip(own, sets))
    got = lang._kernel(sets, sets)
    want = np.array([[len(a & b) / max(1, len(a) * len(b)) ** 0.5 for b in own] for a in own])
    assert np.abs(got - want).max() < 0.03


def test_pieces_of_long_texts(monkeypatch):
    flags = np.zeros(lang.FEATURES, bool)
    text = " ".join(SAMPLES.values()) * 3
    whole = lang.ngrams(text, flags)
    monkeypatch.setattr(lang, "STEP", 7)
    assert (lang.ngrams(text, flags) == whole).all()


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    rows = lang.language_table(docs).join(docs.select("doc_id", "lang"), "doc_id").collect()
    tested = [r for r in rows if r.held_out]
    assert len(rows) == docs.count() and 0.25 < len(tested) / len(rows) < 0.42
    assert sum(r.lang_pred == r.lang for r in tested) / len(tested) > 0.99
    assert all(0 <= r.score <= 1 for r in rows)


def test_same_predictions_whatever_the_order(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    one = {r.doc_id: (r.lang_pred, round(r.score, 6)) for r in lang.language_table(docs).collect()}
    two = {r.doc_id: (r.lang_pred, round(r.score, 6)) for r in lang.language_table(docs.repartition(7)).collect()}
    assert one == two


def test_odd_rows(odd_docs, docs_of):
    rows = lang.language_table(odd_docs.withColumn("rank", odd_docs.lang)).collect()
    assert len(rows) == 11
    assert {r.lang_pred for r in rows if r.doc_id in (3, 4, 5)} == {"und"}
    assert {r.lang_pred for r in lang.language_table(docs_of([(1, "abc", None, "s"), (2, None)])).collect()} == {"und"}
    assert lang.language_table(docs_of([])).collect() == []


def test_one_language_and_many_copies(docs_of):
    rows = [(i, SAMPLES["en"], "en", "s") for i in range(900)] + [(1000 + i, f"{SAMPLES['de']} {i}", "de", "s") for i in range(40)]
    got = lang.language_table(docs_of(rows)).collect()
    assert {(r.doc_id < 1000, r.lang_pred) for r in got} == {(True, "en"), (False, "de")}
    assert {r.lang_pred for r in lang.language_table(docs_of(rows[:20])).collect()} == {"en"}


def test_a_language_that_is_mostly_copies(docs_of):
    copies = [(i, SAMPLES["en"], "en", "s") for i in range(40_000)]
    others = [(50_000 + i, f"{SAMPLES[k]} {100 + i}", k, "s") for k in ("en", "de") for i in range(60)]
    many = [(60_000 + i, f"{i} {SAMPLES['fr']}", "fr", "s") for i in range(3000)]
    languages, sets = lang.training_sets(docs_of(copies + others + many))
    # Of each text the whole and pieces of 30 and 80 code points.
    assert Counter(languages) == {"en": 3 * 61, "de": 3 * 60, "fr": 3 * lang.DOCUMENTS} and len(sets) == len(languages)


@pytest.mark.parametrize("text,letters", [("123 !", False), ("é", True), ("中", True), ("", False)])
def test_letters(text, letters):
    assert lang.has_letter(text) == letters
