"""WARC archives written and read as a table of chunks.

Every payload is cut into segments. The first is a `response` record, the others are `continuation` records that name
it (the archive format's own segmentation), so an oversized payload is a run of rows (record identifier, chunk
number). Spark's text writer stores the records and its binary reader lists the files back; an archive file holds a
bounded number of bounded records, and the digest of a payload is carried from chunk to chunk.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bidloom.llm.common import attach
from bidloom.session import materialize, work_folder

# Code points of a chunk, and records of an archive file: a file holds at most their product, four bytes each.
CHUNK = 8192
FILE_RECORDS = 1024
CRLF = "\r\n"
BASE32_DIGITS = "0123456789ABCDEFGHIJKLMNOPQRSTUV"
BASE32_LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"

# Identifiers stay text in Python: a whole number that may be null would become a double there.
RAW = ("record_id string, chunk_no int, page_id string, record_type string, refers_to string, "
       "payload_bytes bigint, payload_digest string, chunk binary")
RECORD = ("record_id string, page_id string, record_type string, refers_to string, payload_bytes bigint, "
          "payload_digest string, chunks int, digest_ok boolean")


def sha1_base32(text: Column) -> Column:
    """SHA-1 of the UTF-8 bytes as 32 base32 letters: ten hex digits are eight base32 digits."""
    digest = F.sha1(F.encode(text, "UTF-8"))
    groups = [F.lpad(F.conv(F.substring(digest, 1 + 10 * i, 10), 16, 32), 8, "0") for i in range(4)]
    return F.translate(F.concat(*groups), BASE32_DIGITS, BASE32_LETTERS)


def with_types(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """page_id, url, html, payload_bytes, payload_digest, record_type, refers_to of each page.

    Of equal payloads of at least `least_bytes`, the record with the largest page_id is the response (every such
    row, if the row repeats) and the others revisit it; a page without an identifier is a response of its own.
    """
    html = F.coalesce(F.col("html"), F.lit(""))
    full = pages.select(
        F.col("page_id").cast("bigint").alias("page_id"), F.col("url").cast("string").alias("url"), html.alias("html"),
        F.octet_length(html).cast("bigint").alias("payload_bytes"), sha1_base32(html).alias("payload_digest"),
    )
    keys = ["payload_digest", "payload_bytes"]
    groups = materialize(full.groupBy(*keys).agg(
        F.max("page_id").alias("newest"), F.count(F.lit(1)).alias("copies")), "payload_groups")
    joined = attach(full, groups, keys, "copies")
    revisit = (F.col("page_id") < F.col("newest")) & (F.col("payload_bytes") >= least_bytes)
    return joined.select(
        "page_id", "url", "html", *keys,
        F.when(revisit, "revisit").otherwise("response").alias("record_type"),
        F.when(revisit, F.col("newest")).alias("refers_to"),
    )


def chunk_rows(typed: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """record_id, chunk_no from 0, chunk, and the record's columns: one row per chunk, cut in one pass.

    A revisit has one empty chunk, as has an empty payload. Record identifiers are unique also for repeated rows.
    """
    pieces = F.regexp_extract_all(F.col("html"), F.lit("(?s).{1,%d}" % chunk), F.lit(0))
    pieces = F.when((F.col("record_type") == "revisit") | (F.col("html") == ""), F.array(F.lit(""))).otherwise(pieces)
    marked = typed.withColumn("ordinal", F.monotonically_increasing_id())
    name = F.md5(F.concat_ws("#", F.coalesce(F.col("page_id").cast("string"), F.lit("null")), "ordinal"))
    uuid = F.concat_ws("-", *[F.substring(name, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))])
    parts = marked.select("*", F.concat(F.lit("urn:uuid:"), uuid).alias("record_id"), F.size(pieces).alias("chunks"),
                          F.posexplode(pieces).alias("chunk_no", "chunk"))
    return parts.drop("html", "ordinal")


def _field(name: str, value: Column) -> Column:
    """A header line, or nothing where the value is null."""
    return F.coalesce(F.concat(F.lit(f"{name}: "), value.cast("string"), F.lit(CRLF)), F.lit(""))


def record_text(chunks: DataFrame) -> DataFrame:
    """`value`: header, blank line and block of each chunk's record; the writer adds the two line ends after it."""
    first = F.col("chunk_no") == 0
    kind = F.when(first, F.col("record_type")).otherwise("continuation")
    own = F.when(first, F.col("record_id")).otherwise(F.concat_ws("-", "record_id", "chunk_no"))
    url = F.regexp_replace(F.col("url"), r"[\x00-\x20]", "%20")
    many = F.col("chunks") > 1
    header = F.concat(
        F.lit("WARC/1.1" + CRLF),
        _field("WARC-Type", kind), _field("WARC-Record-ID", F.concat(F.lit("<"), own, F.lit(">"))),
        _field("WARC-Date", F.lit("1970-01-01T00:00:00Z")), _field("WARC-Target-URI", url),
        _field("Content-Type", F.lit("text/html; charset=utf-8")),
        _field("WARC-Payload-Digest", F.concat(F.lit("sha1:"), "payload_digest")),
        _field("WARC-Segment-Number", F.when(many, F.col("chunk_no") + 1)),
        _field("WARC-Segment-Origin-ID", F.when(~first, F.concat(F.lit("<"), "record_id", F.lit(">")))),
        _field("WARC-Segment-Total-Length", F.when(many & (F.col("chunk_no") == F.col("chunks") - 1),
                                                   F.col("payload_bytes"))),
        _field("X-Page-Id", F.col("page_id")), _field("X-Refers-To-Page-Id", F.col("refers_to")),
        _field("X-Payload-Length", F.col("payload_bytes")),
        _field("Content-Length", F.octet_length("chunk")),
    )
    return chunks.select(F.concat(header, F.lit(CRLF), F.col("chunk")).alias("value"))


def write_archives(typed: DataFrame, folder: str, chunk: int = CHUNK, file_records: int = FILE_RECORDS) -> None:
    """Compressed archives in `folder`, which all executors can reach."""
    writer = record_text(chunk_rows(typed, chunk)).write.option("lineSep", CRLF * 2).option("compression", "gzip")
    writer.option("maxRecordsPerFile", file_records).text(folder)


class _Inflated:
    """The bytes of a gzip file, inflated a little at a time."""

    def __init__(self, data: bytes, step: int = 1 << 16):
        self._data, self._step, self._at, self._left = memoryview(data), step, 0, b""
        self._inflate = zlib.decompressobj(wbits=31)

    def _more(self) -> bool:
        if self._inflate.eof:
            rest = self._inflate.unused_data or bytes(self._data[self._at:])
            if not rest:
                return False
            self._data, self._at, self._inflate = memoryview(rest), 0, zlib.decompressobj(wbits=31)
        if self._at >= len(self._data):
            return False
        self._left += self._inflate.decompress(self._data[self._at:self._at + self._step])
        self._at += self._step
        return True

    def until(self, mark: bytes) -> bytes:
        while (end := self._left.find(mark)) < 0:
            if not self._more():
                return b""
        out, self._left = self._left[:end], self._left[end + len(mark):]
        return out

    def take(self, n: int) -> bytes:
        while len(self._left) < n:
            if not self._more():
                raise ValueError("an archive ends inside a record")
        out, self._left = self._left[:n], self._left[n:]
        return out


def _digest(state) -> str:
    return base64.b32encode(state.digest()).decode()


def _records(data: bytes) -> Iterator[tuple]:
    """Rows of RAW from one archive. A chunk that is the whole payload is digested here and not passed on."""
    source = _Inflated(data)
    while head := source.until(b"\r\n\r\n"):
        lines = head.decode().split(CRLF)
        fields = dict(line.split(": ", 1) for line in lines[1:])
        block = source.take(int(fields["Content-Length"]))
        source.take(4)
        kind, number = fields["WARC-Type"], int(fields.get("WARC-Segment-Number", 1))
        record = fields.get("WARC-Segment-Origin-ID", fields["WARC-Record-ID"]).strip("<>")
        length, stated = int(fields["X-Payload-Length"]), fields["WARC-Payload-Digest"].removeprefix("sha1:")
        if kind == "response" and len(block) == length and _digest(hashlib.sha1(block)) != stated:
            raise ValueError(f"{record}: the payload does not have the digest its header states")
        whole = kind == "revisit" or len(block) == length
        yield (record, number - 1, fields.get("X-Page-Id"), kind, fields.get("X-Refers-To-Page-Id"), length, stated,
               None if whole else block)


def _parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    names = [part.split()[0] for part in RAW.split(", ")]

    def frame(rows):
        return pd.DataFrame(rows, columns=names, dtype=object)

    for batch in batches:
        for data in batch["content"]:
            rows = []
            for row in _records(bytes(data)):
                rows.append(row)
                if len(rows) >= 256:
                    yield frame(rows)
                    rows = []
            if rows:
                yield frame(rows)


def _joined(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """One row per record from its chunks in order; only a running digest is held, across batches too."""
    names = [part.split()[0] for part in RECORD.split(", ")]
    head, state, seen, size = None, None, 0, 0

    def done():
        whole = state is None or (_digest(state) == head.payload_digest and size == head.payload_bytes)
        return (head.record_id, head.page_id, head.record_type, head.refers_to, head.payload_bytes,
                head.payload_digest, seen, whole)

    for batch in batches:
        out = []
        for row in batch.itertuples(index=False):
            if head is None or row.record_id != head.record_id:
                if head is not None:
                    out.append(done())
                head, state, seen, size = row, None, 0, 0
            seen += 1
            if row.chunk is not None:
                state = state or hashlib.sha1()
                state.update(row.chunk)
                size += len(row.chunk)
        if out:
            yield pd.DataFrame(out, columns=names, dtype=object)
    if head is not None:
        yield pd.DataFrame([done()], columns=names, dtype=object)


def read_chunks(spark: SparkSession, folder: str) -> DataFrame:
    """The chunk table of the archives in a folder: one row per WARC record, `chunk` null if it is the whole payload."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(folder)
    return files.select("content").mapInPandas(_parse, RAW)


def read_records(spark: SparkSession, folder: str) -> DataFrame:
    """One row per record, digests checked: RECORD. Chunks of a record meet sorted; none is put together."""
    chunks = read_chunks(spark, folder).repartition("record_id").sortWithinPartitions("record_id", "chunk_no")
    records = chunks.mapInPandas(_joined, RECORD)
    return records.withColumns({c: F.col(c).cast("bigint") for c in ("page_id", "refers_to")})


def round_trip(pages: DataFrame, least_bytes: int = 0, chunk: int = CHUNK) -> DataFrame:
    """Archives of all pages, written under the shared work folder and read back; one row per page.

    Null html is an empty payload. An empty table writes no record and gives no rows. A digest that does not hold
    raises an error, so a returned row has been verified.
    """
    spark = pages.sparkSession
    folder = work_folder(spark, "warc")
    write_archives(with_types(pages, least_bytes), folder, chunk)
    read = read_records(spark, folder)
    checked = F.when(F.col("digest_ok"), F.col("payload_digest")).otherwise(
        F.raise_error(F.concat(F.lit("digest differs in "), "record_id")))
    return read.select("page_id", "payload_bytes", checked.alias("payload_digest"), "record_type", "refers_to", "chunks")
