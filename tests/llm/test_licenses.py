import random
import re

from bidloom.llm import licenses

NOTICE = "Licensed under the Apache License, Version 2.0"
FILL = "river stone window paper garden yellow seven quiet"


def lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def brute(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text))
    places, labels, score = [], set(), 0.0
    base = set()
    for t in licenses.TEMPLATES:
        own = licenses.split_words(t.text)
        if t.exact:
            at = [i for i in range(len(words) - len(own) + 1) if words[i:i + len(own)] == own]
            places += at
            if at:
                base.add(t.label)
                score = 1.0
        else:
            for start in range(0, max(len(words), 1), licenses.STEP):
                block = set(words[start:start + licenses.BLOCK])
                share = len(block & set(own)) / len(set(own))
                if share >= licenses.THRESHOLD:
                    labels.add(t.label)
                    score = max(score, share)
    return (len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(base)),
            ",".join(sorted(base | labels)), score)


def check(docs):
    texts = [(r.doc_id, r.text) for r in docs.collect()]
    got = sorted((tuple(r) for r in licenses.license_table(docs).collect()), key=repr)
    assert got == sorted(((i, *brute(t)) for i, t in texts), key=repr)
    return got


def test_against_brute_force(docs_of):
    rng = random.Random(3)
    rows = []
    for i in range(60):
        parts = [rng.choice(FILL.split()) for _ in range(rng.randrange(400))]
        for _ in range(rng.randrange(4)):
            notice = licenses.split_words(rng.choice(licenses.TEMPLATES).text)
            for _ in range(rng.randrange(4)):
                notice[rng.randrange(len(notice))] = rng.choice([*FILL.split(), "license", "the"])
            at = rng.randrange(len(parts) + 1)
            parts[at:at] = notice
        rows.append((i, rng.choice([" ", ", ", "\n"]).join(parts)))
    rows.append((100, f"{NOTICE}\nGNU GENERAL Public license; cc-by. CC BY MIT license"))
    got = check(docs_of(rows))
    assert sum(bool(r[6]) for r in got) > 30


def test_phrases_over_block_borders(docs_of):
    rows = [(n, "w " * n + "gnu general public license " + "w " * 70 + "cc by") for n in range(56, 70)]
    check(docs_of(rows))


def test_odd_rows(odd_docs, docs_of):
    check(odd_docs)
    check(docs_of([(1, None), (2, "cc by cc by"), (2, "cc by cc by"), (None, NOTICE), (3, "cc éby"), (4, "K cc by")]))
    assert licenses.license_table(docs_of([])).collect() == []
