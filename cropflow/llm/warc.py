"""Operator 11: a content-addressed WARC archive.

Payload bytes are stored once, under their SHA-256; the exact header block of
every record is stored apart, with that digest; records are rebuilt by a join
of the two tables.

1. ``_facts``: one map over the pages writes ids, digests and lengths. Two
   payloads that share a SHA-256 but differ in SHA-1 or length stop the job, so
   equal digests stand for equal bytes.
2. ``_kinds``: digests are aggregated (partially, before the shuffle); of the
   records that share a payload of at least ``min_revisit`` bytes the one with
   the largest page_id holds it, the others revisit that one.
3. Payloads: a Bloom filter of the digests that occur more than once lets the
   others pass to the store without a shuffle; the rest are cut to one row per
   digest within each task, then across tasks.
4. ``records`` joins headers and payloads on the digest (Spark splits a digest
   that a third of all records hold), recomputes SHA-256 and SHA-1 of the bytes
   it read and fails on a difference.

``export`` writes standard WARC files (Spark's text writer, whose line
separator is the blank lines that end a record) and ``read_files`` reads such
files, gzipped or not, one task per file in constant chunks, framed by
Content-Length alone.

Edge cases: a null html is an empty payload; a null url gives no
WARC-Target-URI, and control characters in a url are percent-encoded; a null
page_id is the smallest (it holds a payload only if no other record does, and
its revisits refer to null); repeated rows are records of their own, one of
them the response; an empty table gives empty archives; other columns are
ignored. A record is held whole in memory while it is written or rebuilt, as
its row is.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bloom
from .store import written

MIN_REVISIT = 1_000
DATE = "1970-01-01T00:00:00Z"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_END = "\r\n\r\n"


class Archive(NamedTuple):
    """The two stored tables: headers (page_id, header, sha256) and payloads (sha256, payload)."""

    headers: DataFrame
    payloads: DataFrame


def _payload() -> Column:
    return F.coalesce(F.col("html"), F.lit("")).cast("binary")


def _facts(pages: DataFrame) -> DataFrame:
    p = _payload()
    return pages.select("page_id", "url", F.unhex(F.sha2(p, 256)).alias("sha256"), F.unhex(F.sha1(p)).alias("sha1"),
                        F.octet_length(p).cast("long").alias("bytes"), F.monotonically_increasing_id().alias("row"))


def _kinds(facts: DataFrame) -> DataFrame:
    """Per digest: number of records, the holder's row and page_id."""
    differ = (F.min("sha1") != F.max("sha1")) | (F.min("bytes") != F.max("bytes"))
    kinds = facts.groupBy("sha256").agg(
        F.count("*").alias("times"), F.max("page_id").alias("holder_id"),
        F.coalesce(F.max_by("row", "page_id"), F.min("row")).alias("holder"), differ.alias("differ"))
    return kinds.withColumn("times", F.when(F.col("differ"), F.raise_error(F.lit("two payloads share a SHA-256"))).otherwise(F.col("times"))).drop("differ")


def _record_id(page_id: Column, row: Column) -> Column:
    return F.concat(F.lit("<urn:page:"), F.coalesce(page_id.cast("string"), F.lit("none")), F.lit(":"), row.cast("string"), F.lit(">"))


def _header(min_revisit: int, date: str) -> Column:
    """The exact header block: WARC fields, blank line, HTTP fields, blank line."""
    revisit = (F.col("bytes") >= min_revisit) & (F.col("row") != F.col("holder"))
    digest = F.concat(F.lit("sha1:"), F.lower(F.hex("sha1")))
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.col("bytes").cast("string"), F.lit(_END))
    block = F.octet_length(http) + F.when(revisit, F.lit(0)).otherwise(F.col("bytes"))
    target = F.col("url")
    for code in (*range(32), 127):
        target = F.replace(target, F.lit(chr(code)), F.lit(f"%{code:02X}"))
    fields = [
        F.concat(F.lit("WARC/1.1\r\nWARC-Type: "), F.when(revisit, "revisit").otherwise("response")),
        F.concat(F.lit("WARC-Record-ID: "), _record_id(F.col("page_id"), F.col("row"))),
        F.lit(f"WARC-Date: {date}"),
        F.concat(F.lit("WARC-Target-URI: "), target),
        F.concat(F.lit("WARC-Payload-Digest: "), digest),
        F.when(revisit, F.concat(F.lit("WARC-Refers-To: "), _record_id(F.col("holder_id"), F.col("holder")))),
        F.when(revisit, F.lit(f"WARC-Profile: {_PROFILE}")),
        F.lit("Content-Type: application/http; msgtype=response"),
        F.concat(F.lit("Content-Length: "), block.cast("string")),
    ]
    return F.concat(F.concat_ws("\r\n", *fields), F.lit(_END), http)


def _shared(filter_words):
    """sha256, payload and whether the digest may occur more than once."""
    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                maybe = bloom.maybe(filter_words.value, batch.column("h").to_numpy().view(np.uint64))
                yield pa.RecordBatch.from_arrays([batch.column("sha256"), batch.column("payload"), pa.array(maybe)], ["sha256", "payload", "shared"])
    return emit


def archive(pages: DataFrame, min_revisit: int = MIN_REVISIT, date: str = DATE) -> Archive:
    """pages (page_id, url, html) -> the stored archive."""
    sc = pages.sparkSession.sparkContext
    facts = written(_facts(pages), "warc-facts")
    kinds = written(_kinds(facts), "warc-kinds")
    rows = facts.join(kinds.drop("times"), "sha256")
    headers = written(rows.select("page_id", _header(min_revisit, date).alias("header"), "sha256"), "warc-headers")
    repeated = kinds.where("times > 1").select(F.xxhash64("sha256").alias("h"))
    filter_words = sc.broadcast(bloom.build(repeated, "h"))
    digest = F.unhex(F.sha2(_payload(), 256))
    bytes_ = pages.select(digest.alias("sha256"), _payload().alias("payload")).withColumn("h", F.xxhash64("sha256"))
    flagged = bytes_.mapInArrow(_shared(filter_words), "sha256 binary, payload binary, shared boolean")
    once = flagged.where("not shared").select("sha256", "payload")
    copies = flagged.where("shared").groupBy("sha256").agg(F.min("payload").alias("payload"))
    return Archive(headers, written(once.unionByName(copies), "warc-payloads"))


def records(stored: Archive) -> DataFrame:
    """page_id, header, payload, payload_sha1 of every record; bytes that don't fit their digest stop the job."""
    held = stored.payloads.withColumnRenamed("sha256", "key")
    joined = stored.headers.join(held, F.col("sha256") == F.col("key"), "left")
    sha1 = F.sha1("payload")
    named = F.concat(F.lit("sha1:"), sha1) == header_field("WARC-Payload-Digest")
    whole = F.coalesce((F.unhex(F.sha2("payload", 256)) == F.col("sha256")) & named, F.lit(False))
    return joined.select("page_id", "header", F.when(whole, F.col("payload")).otherwise(F.raise_error(F.lit("a payload is lost or damaged"))).alias("payload"),
                         sha1.alias("payload_sha1"))


def header_field(name: str, header: str = "header") -> Column:
    """The field's value in the WARC part of the header block; null if absent."""
    warc = F.substring_index(header, _END, 1)
    return F.nullif(F.regexp_extract(warc, rf"(?i)\r\n{name}:[ \t]*([^\r\n]*)", 1), F.lit(""))


def export(recs: DataFrame, path: str, compression: str = "gzip") -> None:
    """Records as WARC files: header block, payload (not for a revisit) and two line ends each."""
    block = F.when(header_field("WARC-Type") == "revisit", F.lit(b"")).otherwise(F.col("payload"))
    text = F.concat(F.col("header").cast("binary"), block).cast("string")
    recs.select(text.alias("value")).write.option("lineSep", _END).option("compression", compression).text(path)


# ---------------------------------------------------------------- reading WARC files

class _Stream:
    """Bytes of one file in chunks, gzip members opened."""

    def __init__(self, path: str, chunk: int):
        from pyarrow import fs

        filesystem, p = fs.FileSystem.from_uri(path)
        self.file, self.chunk = filesystem.open_input_stream(p, compression=None), chunk
        self.held, self.at = b"", 0
        first = self.file.read(chunk)
        self.unzip = zlib.decompressobj(31) if first[:2] == b"\x1f\x8b" else None
        self.raw = first

    def _more(self) -> bool:
        while True:
            raw, self.raw = self.raw or self.file.read(self.chunk), b""
            if not raw:
                return False
            if self.unzip is None:
                new = raw
            else:
                new = self.unzip.decompress(raw, self.chunk)
                if self.unzip.eof:
                    self.raw, self.unzip = self.unzip.unused_data, zlib.decompressobj(31)
                else:
                    self.raw = self.unzip.unconsumed_tail
            if new:
                self.held, self.at = self.held[self.at:] + new, 0
                return True

    def until(self, mark: bytes) -> bytes | None:
        """Up to and with the mark; None at the end of the file."""
        seen = 0
        while (end := self.held.find(mark, self.at + max(0, seen - len(mark)))) < 0:
            seen = len(self.held) - self.at
            if not self._more():
                return None
        out, self.at = self.held[self.at : end + len(mark)], end + len(mark)
        return out

    def take(self, n: int) -> bytes:
        parts, have = [], 0
        while True:
            part = self.held[self.at : self.at + n - have]
            parts.append(part)
            have += len(part)
            self.at += len(part)
            if have == n:
                return b"".join(parts)
            if not self._more():
                raise ValueError("a WARC record is cut off")


def _parse(path: str, chunk: int) -> Iterator[tuple[bytes, bytes]]:
    stream = _Stream(path, chunk)
    while (warc := stream.until(b"\r\n\r\n")) is not None:
        fields = dict(line.split(b":", 1) for line in warc.lower().split(b"\r\n")[1:] if b":" in line)
        block = stream.take(int(fields[b"content-length"]))
        stream.take(4)
        cut = block.find(b"\r\n\r\n") + 4 if fields.get(b"content-type", b"").strip().startswith(b"application/http") and b"\r\n\r\n" in block else 0
        yield warc + block[:cut], block[cut:]


def _read(chunk: int, batch_bytes: int):
    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column("path").to_pylist():
                heads, payloads, size = [], [], 0
                for head, payload in _parse(path, chunk):
                    heads.append(head.decode("utf-8", "surrogateescape").encode("utf-8", "replace").decode("utf-8"))
                    payloads.append(payload)
                    size += len(head) + len(payload)
                    if size > batch_bytes:
                        yield pa.RecordBatch.from_arrays([pa.array(heads, pa.string()), pa.array(payloads, pa.binary())], ["header", "payload"])
                        heads, payloads, size = [], [], 0
                yield pa.RecordBatch.from_arrays([pa.array(heads, pa.string()), pa.array(payloads, pa.binary())], ["header", "payload"])
    return emit


def read_files(spark: SparkSession, path: str, chunk: int = 1 << 20, batch_bytes: int = 8 << 20) -> DataFrame:
    """WARC files under ``path`` -> header, payload of every record."""
    files = spark.read.format("binaryFile").load(path).select("path", "length")
    spread = files.repartition(spark.sparkContext.defaultParallelism * 4, "path").select("path")
    return spread.mapInArrow(_read(chunk, batch_bytes), "header string, payload binary")


# ---------------------------------------------------------------- query

def op11_warc_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Archives every page and returns what the records read back say."""
    back = records(archive(spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html")))
    of = lambda field: F.regexp_extract(header_field(field), r"^<urn:page:(-?\d+):", 1).try_cast("long")
    return back.select(of("WARC-Record-ID").alias("page_id"), F.octet_length("payload").cast("long").alias("payload_bytes"),
                       F.col("payload_sha1").alias("payload_digest"), header_field("WARC-Type").alias("record_type"),
                       of("WARC-Refers-To").alias("refers_to"))


ORACLE_SQL = f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS body FROM pages),
held AS (
  SELECT page_id, body, octet_length(encode(body)) AS n,
         row_number() OVER (PARTITION BY body ORDER BY page_id DESC NULLS LAST) AS nth,
         max(page_id) OVER (PARTITION BY body) AS newest
  FROM p)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, sha1(body) AS payload_digest,
       CASE WHEN n >= {MIN_REVISIT} AND nth > 1 THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN n >= {MIN_REVISIT} AND nth > 1 THEN newest END AS refers_to
FROM held
"""
