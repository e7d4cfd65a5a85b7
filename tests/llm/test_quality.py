import math
import re
import struct
from collections import Counter

import pytest
import xxhash
from pyspark.sql import functions as F

from bidloom.llm import quality

SPACE = re.compile(r"[\x20\x09-\x0D]+")


def words(text):
    return [w for w in SPACE.split(text or "") if w]


def brute(text):
    w = words(text)
    seen = Counter(tuple(w[i:i + 8]) for i in range(len(w) - 7))
    covered = {i + k for i in range(len(w) - 7) if seen[tuple(w[i:i + 8])] > 1 for k in range(8)}
    lines = [x for x in (text or "").split("\n") if words(x)]
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(covered))


def signed(n):
    return n - 2**64 if n >> 63 else n


def buckets(text):
    """The hash buckets by another implementation of the same hash: a number's bytes, chained by seeds."""
    h = [signed(xxhash.xxh64_intdigest(w.encode(), 42)) for w in words(text)]
    chain = lambda a, b: signed(xxhash.xxh64_intdigest(struct.pack("<q", b), xxhash.xxh64_intdigest(struct.pack("<q", a), 42)))
    return [x % quality.BUCKETS for x in h] + [chain(a, b) % quality.BUCKETS for a, b in zip(h, h[1:])]


def test_against_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    good = {r.doc_id for r in labels.filter("quality = 1").collect()}
    raw, trusted = Counter(), Counter()
    for doc_id, text in texts.items():
        raw.update(buckets(text))
        if doc_id in good:
            trusted.update(buckets(text))
    size = quality.BUCKETS
    every = sum(raw.values()) + size
    share = [(raw[b] + 1) / every for b in range(size)]
    total = sum(trusted.values()) + quality.PRIOR
    ratio = [math.log((trusted[b] + quality.PRIOR * share[b]) / total) - math.log(share[b]) for b in range(size)]
    for r in quality.quality_table(docs, labels).collect():
        text = texts[r.doc_id]
        assert tuple(r[c] for c in quality.STATISTICS) == brute(text)
        own = buckets(text)
        mean = sum(ratio[b] for b in own) / len(own) if own else 0.0
        assert r.llr == pytest.approx(mean, abs=1e-9)
        failed = r.n_words < 20 or 100 * r.n_repeat_words > 30 * r.n_words
        assert r.base_failed == failed and r.kept == (not failed and r.llr >= quality.THRESHOLD)


def test_clean_labelled_documents_stay(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    rows = quality.quality_table(docs, labels).filter("not base_failed").join(labels, "doc_id")
    kept = {r.quality: r.share for r in rows.groupBy("quality").agg(F.avg(F.col("kept").cast("int")).alias("share")).collect()}
    assert kept[1] > 0.995 and kept[0] < 0.6


def test_repeats_and_odd_rows(odd_docs, docs_of, labels_of):
    labels = labels_of([(1, 1, 0), (1, 1, 0), (None, 1, None), (7, 0, None), (2, None, None)])
    rows = quality.quality_table(odd_docs, labels).collect()
    assert len(rows) == 11
    texts = {r.doc_id: r.text for r in odd_docs.collect() if r.doc_id}
    for r in rows:
        if r.doc_id:
            assert tuple(r[c] for c in quality.STATISTICS) == brute(texts[r.doc_id])
            assert not (r.kept and r.base_failed)
    assert quality.quality_table(docs_of([]), labels).collect() == []
    untaught = quality.quality_table(odd_docs, labels_of([])).collect()
    assert {r.llr for r in untaught} == {0.0} and {r.kept for r in untaught if not r.base_failed} == {True}


def test_documents_keep_their_columns(odd_docs, labels_of):
    kept = quality.kept_documents(odd_docs, labels_of([(1, 1, 0)]))
    assert kept.columns == odd_docs.columns and {r.kept for r in kept.collect()} == {"mine"}
    assert {r.doc_id for r in kept.collect()} == {None, 1, 2}
