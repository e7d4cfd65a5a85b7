import random
from collections import Counter

import numpy as np
import pytest

from bidloom.llm import jaccard


def plain_set(text):
    words = "".join(x.lower() if "A" <= x <= "Z" else x for x in text or "").encode().split()
    grams = {tuple(words[i:i + 4]) for i in range(len(words) - 3)}
    return grams or ({tuple(words)} if words else set())


def plain_table(rows, percent=85):
    sets = [plain_set(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i] = root[root[i]]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if both and 100 * both >= percent * (len(a) + len(sets[j]) - both):
                root[find(i)] = find(j)
    least = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            least[find(i)] = min(doc, least.get(find(i), doc))
    return Counter((doc, len(sets[i]), least.get(find(i))) for i, (doc, _) in enumerate(rows))


def run(docs, **options):
    return Counter(map(tuple, jaccard.component_table(docs, **options).collect()))


def near_copies(seed, groups=12, copies=14, edits=4):
    """Groups of texts at different distances, with lines that many of them have."""
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choice("abcdefg") for _ in range(4)) for _ in range(300)]
    lines = [" ".join(rng.choice(vocabulary) for _ in range(12)) for _ in range(6)]
    rows = []
    for _ in range(groups):
        base = [rng.choice(vocabulary) for _ in range(rng.choice([1, 3, 4, 30, 90, 250]))]
        for _ in range(copies):
            words = list(base)
            for _ in range(rng.randrange(edits)):
                words[rng.randrange(len(words))] = rng.choice(vocabulary).upper()
            text = rng.choice([" ", "\n", "\t "]).join(words)
            rows.append((len(rows), "\n".join([text, *rng.sample(lines, rng.randrange(3))])))
    rows += [(len(rows) + i, "\n".join(rng.sample(lines, 4))) for i in range(30)]
    return rows


def chain(first, seed=4):
    """Each text differs from the next by a few words, so the chain is one component though its ends share little."""
    rng = random.Random(seed)
    words = [f"w{rng.randrange(10**6)}" for _ in range(120)]
    return [(first - i, " ".join(words[3 * i % 60: 3 * i % 60 + 60])) for i in range(20)]


def many_copies(first, count=300):
    """A third of the rows are one text, another third differ from it in one word."""
    rng = random.Random(2)
    base = [f"w{rng.randrange(1000)}" for _ in range(100)]
    rows = []
    for i in range(count):
        words = list(base) if i % 3 < 2 else [f"v{rng.randrange(10**6)}" for _ in range(20)]
        if i % 3 == 1:
            words[rng.randrange(100)] = f"x{i}"
        rows.append((first + i, " ".join(words)))
    return rows


def test_against_all_pairs(docs_of):
    rows = near_copies(128) + chain(2000) + many_copies(3000)
    # 17 of 20 shingles in common is a link, 16 of 19 is none.
    rows += [(5200, "a b c d e f g h i j k l m n o p q r s t"), (5201, "A B C D E F G H I J K L M N O P Q R S T u v w"),
             (5300, "1 2 3 4 5 6 7 8 9 10 11 12 13 14 15 16 17 18 19"),
             (5301, "1 2 3 4 5 6 7 8 9 10 11 12 13 14 15 16 17 18 19 20 21 22")]
    got = run(docs_of(rows))
    assert got == plain_table(rows)
    assert 12 < len({c for _, _, c in got}) < len(rows)
    assert (5201, 20, 5200) in got and (5301, 19, 5301) in got
    assert sum(n for (_, _, c), n in got.items() if c == 3000) == 200


def test_divided_buckets(docs_of, monkeypatch):
    """Buckets of at most two members outside the largest component, and one round: nearly all are divided."""
    monkeypatch.setattr(jaccard, "ROUNDS", 1)
    rows = near_copies(3, groups=3, copies=6, edits=3)
    assert run(docs_of(rows), bucket=2) == plain_table(rows)


def test_odd_rows(odd_docs):
    rows = [(r.doc_id, r.text) for r in odd_docs.collect()]
    assert run(odd_docs.repartition(4)) == plain_table(rows)


def test_empty_table(docs_of):
    assert jaccard.component_table(docs_of([])).collect() == []


def test_sets_in_pieces(monkeypatch):
    text = " ".join(f"word{i % 77}" for i in range(3000))
    whole, sizes = jaccard.ngram_sets([text, None, "a b", text], 4, jaccard._WordHashes())
    monkeypatch.setattr(jaccard, "PIECE", 50)
    cut, _ = jaccard.ngram_sets([text, None, "a b", text], 4, jaccard._WordHashes())
    assert np.array_equal(whole, cut) and sizes.tolist() == [len(plain_set(text)), 0, 1, len(plain_set(text))]


def near_sets(seed, percent):
    """Sorted sets of random numbers around the limit, most of them near some others."""
    rng = np.random.default_rng(seed)
    out = []
    for size in (1, 2, 5, 6, 7, 8, 9, 13, 20, 40, 100, 300) * 3:
        base = rng.integers(0, 2**64, size, dtype=np.uint64)
        for _ in range(10):
            gone = rng.choice(size, rng.integers(0, size * (100 - percent) // 100 + 1), replace=False)
            more = rng.integers(0, 2**64, int(rng.integers(0, size * (100 - percent) // 100 + 1)), dtype=np.uint64)
            out.append(np.unique(np.concatenate([np.delete(base, gone), more])))
    return [s for s in out if len(s)]


def test_linked_sets_share_a_segment():
    for percent, way in ((85, 1), (85, 2), (60, 1), (95, 1)):
        sets = near_sets(percent + way, percent)
        hashes, sizes = np.concatenate(sets), np.array([len(s) for s in sets])
        keys, counts = jaccard.segment_keys(hashes, sizes, percent, way)
        filed = [set(k.tolist()) for k in np.split(keys, np.cumsum(counts)[:-1])]
        sketches = jaccard._sketches(hashes, sizes).view(np.uint64)
        links = 0
        for i, x in enumerate(sets):
            for j in range(i):
                both = len(np.intersect1d(x, sets[j], assume_unique=True))
                union = len(x) + len(sets[j]) - both
                if both < union and 100 * both >= percent * union:
                    links += 1
                    assert filed[i] & filed[j]
                    assert np.bitwise_count(sketches[i] ^ sketches[j]).sum() <= union - both
        assert links > 20


def test_a_common_line_makes_no_buckets(docs_of):
    """Texts that have only a line in common used to meet in one bucket for each n-gram of a prefix."""
    rng = random.Random(5)
    line = " ".join(f"c{i}" for i in range(12))
    rows = [(i, " ".join(f"w{rng.randrange(10**9)}" for _ in range(100)) + "\n" + line) for i in range(400)]
    rows += [(1000 + i, rows[i][1] + " end") for i in range(5)]
    docs = docs_of(rows).select("doc_id", "text")
    filed = jaccard.filed_sets(jaccard.filed_documents(docs.selectExpr("*", "doc_id AS row"), 4, 85))
    assert filed.select("cid").distinct().count() <= 20
    assert run(docs_of(rows)) == plain_table(rows)


def test_components_in_one_task_and_in_rounds(spark, monkeypatch):
    rng = random.Random(6)
    edges = spark.createDataFrame([(rng.randrange(300), rng.randrange(300)) for _ in range(150)], "a bigint, b bigint")
    small = set(map(tuple, jaccard._components(edges.filter("a <> b")).collect()))
    monkeypatch.setattr(jaccard, "FEW", 0)
    assert small == set(map(tuple, jaccard._components(edges.filter("a <> b")).collect())) and len(small) > 50


@pytest.mark.parametrize("sent", [1 << 16, 0])
def test_few_sets_are_shuffled(spark, monkeypatch, sent):
    """Each comparison used to shuffle the n-grams of all sets, and those of a pair's sets up to five times."""
    monkeypatch.setattr(jaccard, "SENT", sent)
    rng = random.Random(7)
    rows = [(rng.randrange(-2**63, 2**63), [rng.randrange(2**63) for _ in range(20)]) for _ in range(3000)]
    rows += [(i, rows[0][1][:19] + [i]) for i in range(40)]
    sets = spark.createDataFrame([(i, len(t), t) for i, t in rows], "cid bigint, n bigint, tokens array<bigint>")
    pairs = spark.createDataFrame([(min(i, rows[0][0]), max(i, rows[0][0])) for i in range(40)] + [
        (min(i, rows[1][0]), max(i, rows[1][0])) for i in range(40)], "a bigint, b bigint")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        with jaccard.some_sets(sets, jaccard._ends(pairs)) as own:
            kept = [r.cid for r in own.select("cid").collect()]
            assert {*range(40), rows[0][0], rows[1][0]} <= set(kept) and len(kept) < 100
            found = set(map(tuple, jaccard.verified(pairs, own, 85).collect()))
        assert found == {(min(i, rows[0][0]), max(i, rows[0][0])) for i in range(40)}
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        plan = jaccard.verified(pairs, sets, 85)._jdf.queryExecution().explainString(
            spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
        moved = [p for p in plan.split("\n\n") if "Exchange\n" in p and "tokens" in p and "Reused" not in p]
        assert len(moved) <= 3, plan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_sets_picked_by_a_filter(docs_of, monkeypatch):
    """The same components when there are too many ids to be sent, also in buckets that are filed again."""
    monkeypatch.setattr(jaccard, "SENT", 0)
    monkeypatch.setattr(jaccard, "ROUNDS", 1)
    rows = near_copies(9, groups=3, copies=6, edits=3)
    assert run(docs_of(rows), bucket=2) == plain_table(rows)


def test_pieces_of_a_document_with_many_pairs(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "VERIFIED", 4)
    sets = spark.createDataFrame([(i, 7, [*range(6), 100 + i % 9]) for i in range(30)], "cid bigint, n bigint, tokens array<bigint>")
    pairs = [(i, j) for j in range(30) for i in range(j) if i < 2 or j == 29]
    got = [tuple(r) for r in jaccard.verified(spark.createDataFrame(pairs, "a bigint, b bigint"), sets, 85).collect()]
    assert sorted(got) == sorted((i, j) for i, j in pairs if i % 9 == j % 9)
