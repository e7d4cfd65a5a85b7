import base64
import gzip
import hashlib
from collections import Counter
from pathlib import Path

import pytest

from bidloom.llm import warc

SCHEMA = "page_id bigint, url string, html string"
ODD = [(1, "u", "same"), (2, "u", "same"), (3, "u", "other"), (4, None, None), (5, "a b", ""), (None, "u", "same"),
       (2**60 + 1, "u", "big é\U0001f600" * 9000), (2**60 + 3, "u", "big é\U0001f600" * 9000), (6, "u", "x\r\n\r\ny\r\n\r\n"), (3, "u", "other")]


def sha(text):
    return base64.b32encode(hashlib.sha1((text or "").encode()).digest()).decode()


def brute(rows, least=0):
    newest = {}
    for page, _, html in rows:
        if page is not None:
            newest[html or ""] = max(page, newest.get(html or "", page))
    out = []
    for page, _, html in rows:
        body = html or ""
        revisit = page is not None and page < newest[body] and len(body.encode()) >= least
        out.append((page, len(body.encode()), sha(body), "revisit" if revisit else "response", newest[body] if revisit else None))
    return Counter(out)


@pytest.mark.parametrize("chunk", [501, 8192])
def test_round_trip(spark, chunk):
    pages = spark.createDataFrame(ODD, SCHEMA).withColumn("record_id", __import__("pyspark").sql.functions.lit("mine"))
    rows = warc.round_trip(pages, chunk=chunk).collect()
    assert Counter(tuple(r)[:5] for r in rows) == brute(ODD)


def test_least_bytes(spark):
    rows = warc.round_trip(spark.createDataFrame(ODD, SCHEMA), least_bytes=5).collect()
    assert Counter(tuple(r)[:5] for r in rows) == brute(ODD, 5)


def test_many_copies_are_joined_apart(spark, monkeypatch):
    monkeypatch.setattr("bidloom.llm.common.HOT_SHARE", 10)
    rows = [(i, "u", "copy") for i in range(1500)] + [(i, "u", f"own {i}") for i in range(1500, 1600)]
    got = warc.round_trip(spark.createDataFrame(rows, SCHEMA)).collect()
    assert Counter(tuple(r)[:5] for r in got) == brute(rows)


def test_empty(spark):
    assert warc.round_trip(spark.createDataFrame([], SCHEMA)).collect() == []


def test_files_are_archives(spark, tmp_path):
    folder = str(tmp_path / "out")
    warc.write_archives(warc.with_types(spark.createDataFrame([(1, "u", "abcdefgh")], SCHEMA)), folder, chunk=3)
    data = b"".join(gzip.decompress(p.read_bytes()) for p in Path(folder).glob("*.gz"))
    assert data.startswith(b"WARC/1.1\r\n") and data.count(b"WARC-Type: continuation") == 2 and data.endswith(b"\r\n\r\n")
    assert b"WARC-Segment-Total-Length: 8" in data


def test_a_wrong_digest_is_noticed():
    record = (b"WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <r>\r\nWARC-Payload-Digest: sha1:X\r\n"
              b"X-Payload-Length: 2\r\nContent-Length: 2\r\n\r\nab\r\n\r\n")
    with pytest.raises(ValueError):
        list(warc._records(gzip.compress(record)))
