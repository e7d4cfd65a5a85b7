import base64
import math
import random
import re
import string
import time
from collections import Counter

import pytest
from pyspark.sql import functions as F

from bidloom.llm import secrets

KEY = "q7Zp1Vx9Lm3Tn8Rk2Ws6"


def table(docs):
    return {r.doc_id: r for r in secrets.secret_table(docs).collect()}


def test_base_kinds(docs_of):
    rows = table(docs_of([
        (1, "é\U0001f600 PassWord = 'abcdefghijkl' and token:short and secret=" + "z" * 12),
        (2, "AKIAABCDEFGHIJKLMN x AKIAAKIAABCDEFGHIJ AKIASHORT"), (3, "0123456789abcdef 0123456789abcde ABCDEF0123456789ABCDEF"),
        (4, "token=secret:abcdefghijklmnop"), (5, 'api_key":"abcdefghijklmno" apikey=abcdefghijklmno api__key=abcdefghijklmno'),
    ]))
    assert (rows[1].n_assign, rows[1].spans.split(",")[0]) == (2, "assign:3:27")
    assert rows[2].n_access == 2 and rows[3].n_hex == 1
    # The short value uses the text up: the keyword inside it starts no match.
    assert rows[4].n_assign == 0
    assert rows[5].n_assign == 2


@pytest.mark.parametrize("value", [KEY, KEY + KEY.lower(), "a" * 30, "abcdefghij" * 4, "tionthereandingerentionble", "0" * 19 + KEY])
def test_entropy_is_that_of_the_best_window(spark, value):
    best = max(-sum(c / 20 * math.log2(c / 20) for c in Counter(value[i:i + 20]).values()) for i in range(len(value) - 19))
    got = spark.range(1).select(secrets.best_entropy(F.lit(value))).first()[0]
    assert got == pytest.approx(best)


def test_entropy_spans_and_allowed(docs_of):
    uuid = "123e4567-e89b-12d3-a456-426614174000"
    rows = table(docs_of([(1, f"x {KEY} y"), (2, f"example{KEY}"), (3, uuid), (4, "=" * 40), (5, "tionthereandingerentionbleations")]))
    assert rows[1].spans == "entropy_mixed:2:22"
    assert [rows[i].spans for i in (2, 3, 4, 5)] == ["", "", "", ""]


def test_limits_go_by_the_alphabet(docs_of):
    """Random letters are found by class; long natural words and names in capitals are not."""
    rng = random.Random(9)

    def share(letters, length):
        texts = [(i, "".join(rng.choice(letters) for _ in range(length))) for i in range(200)]
        return sum(bool(r.spans) for r in table(docs_of(texts)).values()) / 200

    assert share(string.ascii_letters, 20) > 0.9 and share(string.ascii_letters, 32) > 0.98
    assert share(string.ascii_uppercase, 24) > 0.9
    rows = table(docs_of([(1, "Donaudampfschifffahrtsgesellschaft"), (2, "internationalizations antidisestablishmentarianism")]))
    assert [rows[i].spans for i in (1, 2)] == ["", ""]


def test_cost_grows_with_the_length(docs_of):
    """One megabyte of base64, and 100,000 matches in one text."""
    encoded = base64.b64encode(random.Random(5).randbytes(750_000)).decode()
    started = time.monotonic()
    rows = table(docs_of([(1, encoded), (2, "0123456789abcdef " * 100_000)]))
    assert rows[1].spans == f"entropy_mixed:0:{len(encoded)}"
    assert rows[2].n_hex == 100_000 and rows[2].spans.endswith(f"hex:{17 * 99_999}:{17 * 99_999 + 16}")
    assert time.monotonic() - started < 120


def test_positions_hold_in_the_text(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    found = 0
    for doc_id, row in table(docs).items():
        for span in filter(None, row.spans.split(",")):
            kind, start, end = span.split(":")
            value = texts[doc_id][int(start):int(end)]
            found += 1
            if kind == "hex":
                assert re.fullmatch("[0-9a-f]{16,}", value)
            elif kind == "assign":
                assert re.fullmatch(secrets.ASSIGN, value)
            else:
                assert re.fullmatch(secrets.CANDIDATE, value) or kind == "access"
    assert found > 20


def test_odd_rows(odd_docs, docs_of):
    rows = secrets.secret_table(odd_docs).collect()
    empty = "e3b0c44298fc1c149afbf4c8996fb92427ae41e4649b934ca495991b7852b855"
    assert len(rows) == 11 and {(r.n_assign, r.n_access, r.n_hex, r.base_sha256, r.spans) for r in rows} == {(0, 0, 0, empty, "")}
    assert secrets.secret_table(docs_of([])).collect() == []
