import random
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash

from bidloom.llm import simhash


def slow_fingerprint(text):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").encode().split()
    shingles = [b" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or ([b" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes)) if hashes else 0


def brute_components(prints, distance=2):
    nodes = sorted(set(prints))
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n] = root[root[n]]
        return n

    for i, a in enumerate(nodes):
        for b in nodes[:i]:
            if (a ^ b).bit_count() <= distance:
                root[find(a)] = find(b)
    return {n: find(n) for n in nodes}


def brute_table(rows):
    prints = [(i, slow_fingerprint(t)) for i, t in rows]
    root = brute_components([p for _, p in prints])
    least = {}
    for i, p in prints:
        if i is not None:
            least[root[p]] = min(i, least.get(root[p], i))
    return Counter((i, f"{p:016x}", least.get(root[p])) for i, p in prints)


def table(docs):
    return Counter(map(tuple, simhash.component_table(docs).collect()))


def near_copies(seed=5, documents=30, copies=8):
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choice("abcdefg") for _ in range(5)) for _ in range(500)]
    rows = []
    for _ in range(documents):
        words = [rng.choice(vocabulary) for _ in range(rng.choice([1, 2, 3, 30, 400]))]
        for _ in range(copies):
            changed = list(words)
            for _ in range(rng.randrange(3)):
                changed[rng.randrange(len(changed))] = rng.choice(vocabulary)
            rows.append((len(rows), rng.choice([" ", "\n", " \t "]).join(changed)))
    return rows


def test_against_brute_force(docs_of):
    rows = near_copies()
    got = table(docs_of(rows))
    assert got == brute_table(rows)
    assert len({c for _, _, c in got}) < len({f for _, f, _ in got})


def test_given_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    assert table(docs) == brute_table([tuple(r) for r in docs.collect()])


@pytest.mark.parametrize("bucket", [1, 4, 128])
def test_links_of_crowds(spark, bucket):
    """A dense crowd, chains and random fingerprints, with buckets divided to the last level."""
    rng = random.Random(bucket)
    centre = rng.getrandbits(64)
    prints = {centre ^ (1 << a) ^ (1 << b) for a in range(0, 24) for b in range(a, 24)}
    prints |= {centre ^ ((1 << k) - 1) << 20 for k in range(0, 40, 2)} | {rng.getrandbits(64) for _ in range(300)}
    signed = [p - 2**64 if p >> 63 else p for p in prints]
    classes = spark.createDataFrame([(p,) for p in signed], "fp bigint")
    parts = simhash.fit(np.array(sorted(signed), np.int64).view(np.uint64), len(signed))
    assert sum(p.threshold + 1 for p in parts) == simhash.DISTANCE + 1
    found = simhash.links(classes, parts, bucket=bucket)
    edges = [(r.a, r.b) for r in found.collect()]
    assert all(((a ^ b) % 2**64).bit_count() <= 2 for a, b in edges)
    got = {r.node: r.root for r in simhash.components(found).collect()}
    want = brute_components(list(prints))
    groups, told = defaultdict(set), defaultdict(set)
    for p in prints:
        s = p - 2**64 if p >> 63 else p
        groups[want[p]].add(s)
        told[got.get(s, s)].add(s)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, told.values()))


def test_unequal_thresholds():
    assert simhash.allocate([[0, 5, 50], [0, 1, 2], [0, 9, 90]], 3) == [0, 1, -1]
    assert simhash.allocate([[0, 1], [0, 1], [0, 1]], 3) == [0, 0, 0]
    rng = np.random.default_rng(1)
    sample = rng.integers(0, 2**63, 500, dtype=np.uint64)
    sample = np.where(sample & 1, sample | np.uint64(0xFFFF), sample & ~np.uint64(0xFFFF))
    together = next(g for g in simhash.group_bits(sample, 4) if 0 in g)
    assert set(together) == set(range(16))


def test_partitions_find_every_near_pair():
    rng = random.Random(2)
    sample = np.array([rng.getrandbits(64) for _ in range(300)], np.uint64)
    for total in (300, 10**6, 10**10):
        masks = [m for p in simhash.fit(sample, total) for m in p.masks()]
        for _ in range(300):
            a = rng.getrandbits(64)
            b = a ^ 1 << rng.randrange(64) ^ 1 << rng.randrange(64)
            assert any(a & m == b & m for m in masks)


def test_odd_rows(odd_docs, docs_of):
    assert table(odd_docs) == brute_table([(r.doc_id, r.text) for r in odd_docs.collect()])
    assert simhash.component_table(docs_of([])).collect() == []


def test_survivors(odd_docs, docs_of):
    kept = simhash.survivors(odd_docs)
    assert kept.columns == odd_docs.columns
    ids = [r.doc_id for r in kept.collect()]
    groups = {c for _, _, c in table(odd_docs)}
    assert sorted(ids) == sorted(groups)
    assert simhash.survivors(docs_of([])).collect() == []
    unnamed = docs_of([(None, "a b c"), (None, "a b c"), (None, "d e f")])
    assert sorted(r.text for r in simhash.survivors(unnamed).collect()) == ["a b c", "d e f"]
