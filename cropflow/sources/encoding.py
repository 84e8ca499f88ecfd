"""Encoding detection on the bytes of files, split over tasks.

A file is scanned in ranges of fixed size that may cut characters. Each range
gives a small state: well-formed or not, the offset of its first bad byte, the
continuation bytes it opens with (`head`, at most three) and the unfinished
character it ends with (`tail`). States of neighbours merge by decoding one
tail with the next head, so the result does not depend on the cuts. Ranges are
read through the path's filesystem, as the file digest is (`functions.files`).

An encoding follows from the file alone: a UTF-16 byte-order mark gives utf-16,
no malformed byte gives utf-8 (with or without its mark), anything else
latin-1, which decodes any byte.
"""

from __future__ import annotations

import codecs
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

RANGE_BYTES = 8 << 20
#: A character has at most four bytes, so it meets two ranges at most.
LEAST_RANGE = 4

# Byte-order marks.
MARKS = {"utf-8": codecs.BOM_UTF8, "utf-16-le": codecs.BOM_UTF16_LE, "utf-16-be": codecs.BOM_UTF16_BE}

_SCAN = "path string, start long, length long, mark string, bad_bytes long, first_bad long, head binary, tail binary"


def malformed(data: bytes, final: bool = True) -> tuple[int, int | None, int]:
    """(bytes outside well-formed UTF-8 characters, offset of the first, bytes read); without
    ``final`` an unfinished last character is left unread."""
    spans: list[tuple[int, int]] = []

    def note(error: UnicodeDecodeError):
        spans.append((error.start, error.end))
        return "", error.end

    codecs.register_error("cropflow-note", note)
    _, read = codecs.utf_8_decode(data, "cropflow-note", final)
    return sum(b - a for a, b in spans), spans[0][0] if spans else None, read


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    from pyarrow import fs

    names = [c.split()[0] for c in _SCAN.split(", ")]
    for batch in batches:
        rows = []
        for path, start, length in zip(*(batch.column(c).to_pylist() for c in ("path", "start", "length"))):
            filesystem, p = fs.FileSystem.from_uri(path)
            with filesystem.open_input_file(p) as f:
                f.seek(start)
                data = f.read(length)
            mark = next((n for n, m in MARKS.items() if data.startswith(m)), None) if start == 0 else None
            head = 0
            while start and head < min(3, len(data)) and 0x80 <= data[head] < 0xC0:
                head += 1
            bad, first, read = malformed(data[head:], final=False)
            rows.append((path, start, length, mark, bad, None if first is None else start + head + first, data[:head], data[head + read :]))
        columns = list(zip(*rows)) if rows else [[]] * len(names)
        kinds = [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.binary(), pa.binary()]
        yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds)], names)


def _seams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds what the character between a range and the next one holds of malformed bytes."""
    for batch in batches:
        bad, first = [], []
        for start, length, tail, head in zip(*(batch.column(c).to_pylist() for c in ("start", "length", "tail", "next_head"))):
            n, at, _ = malformed(tail + (head or b""))
            bad.append(n)
            first.append(None if at is None else start + length - len(tail) + at)
        yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("path", "length", "mark", "bad_bytes", "first_bad")), pa.array(bad, pa.int64()), pa.array(first, pa.int64())],
                                         ["path", "length", "mark", "bad_bytes", "first_bad", "seam_bytes", "seam_first"])


def scan_files(spark: SparkSession, path: str, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """path, bytes, mark (byte-order mark or NULL), invalid_bytes, first_invalid (offset or NULL) of every file at `path` that is not empty."""
    step = max(LEAST_RANGE, range_bytes)
    files = spark.read.format("binaryFile").load(path).select("path", "length")
    last = F.greatest(F.col("length") - 1, F.lit(0))
    ranges = files.select("path", F.explode(F.sequence(F.lit(0).cast("long"), last, F.lit(step).cast("long"))).alias("start"), F.col("length").alias("size"))
    ranges = ranges.select("path", "start", F.least(F.lit(step), F.col("size") - F.col("start")).alias("length"))
    states = ranges.repartition("path", "start").mapInArrow(_scan, _SCAN)
    following = F.lead("head").over(Window.partitionBy("path").orderBy("start"))
    merged = states.withColumn("next_head", following).mapInArrow(
        _seams, "path string, length long, mark string, bad_bytes long, first_bad long, seam_bytes long, seam_first long")
    return merged.groupBy("path").agg(
        F.sum("length").alias("bytes"), F.max("mark").alias("mark"), F.sum(F.col("bad_bytes") + F.col("seam_bytes")).alias("invalid_bytes"),
        F.min(F.least("first_bad", "seam_first")).alias("first_invalid"))


def encoding_report(spark: SparkSession, path: str, dataset: str, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """One row: dataset, has_bom, invalid_bytes and the encoding that decodes every file at `path`."""
    files = scan_files(spark, path, range_bytes)
    wide = F.col("mark").startswith("utf-16")
    figures = files.agg(F.coalesce(F.bool_or(F.col("mark").isNotNull()), F.lit(False)).alias("has_bom"),
                        F.coalesce(F.sum("invalid_bytes"), F.lit(0)).alias("invalid_bytes"), F.coalesce(F.bool_or(wide), F.lit(False)).alias("wide"))
    name = F.when(F.col("wide"), "utf-16").when(F.col("invalid_bytes") == 0, "utf-8").otherwise("latin-1")
    return figures.select(F.lit(dataset).alias("dataset"), "has_bom", "invalid_bytes", name.alias("encoding"))


def detect_encoding(spark: SparkSession, path: str) -> str:
    """The encoding that decodes every file at `path`. Lines cut no character of UTF-8, so well-formed
    files are found by a scan of lines within the JVM; the bytes are looked at where that fails."""
    if spark.read.text(path).where(~F.is_valid_utf8("value")).isEmpty():
        return "utf-8"
    return encoding_report(spark, path, "").first()["encoding"]
