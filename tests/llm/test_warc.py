"""Operator 11: archive, rebuilt records and WARC files against plain Python and DuckDB."""

import gzip
import hashlib
import tempfile

import pyarrow as pa
import pytest

from cropflow.llm import warc

from . import data
from .test_operators import _duck, _same

PAGES = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("html", pa.string()), ("header", pa.string())])


def _rows():
    big, other = "é<p>x\r\n\r\nWARC/1.1\r\n" * 80, "y" * 1000
    rows = [(i, f"http://a/{i}", big) for i in range(40)]
    rows += [(100 + i, "u", t) for i, t in enumerate([None, "", "", "small", "small", "z" * 999, "z" * 999, other, other, "x" * 300_000])]
    rows += [(None, None, other), (None, "n", "w" * 2000), (None, "n", "w" * 2000), (7, "a\r\nb: c", big), (39, "again", big), (-3, "neg", "v" * 1500)]
    return [(i, u, t, "clash") for i, u, t in rows]


def _pages(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string, header string")


@pytest.mark.parametrize("rows", [_rows(), []])
def test_query_matches_sql(spark, rows):
    folder = data.fixture_folder([], pages=(PAGES, rows))
    _same(warc.op11_warc_archive(spark, folder), _duck(folder, warc.ORACLE_SQL, ["pages"]))


def test_payloads_are_stored_once_and_records_come_back_exactly(spark):
    rows = _rows()
    stored = warc.archive(_pages(spark, rows))
    payloads = [bytes(r["payload"]) for r in stored.payloads.collect()]
    assert sorted(payloads) == sorted({(t or "").encode() for _, _, t, _ in rows})
    got = warc.records(stored).collect()
    assert sorted((str(r["page_id"]), bytes(r["payload"])) for r in got) == sorted((str(i), (t or "").encode()) for i, _, t, _ in rows)
    for r in got:  # the header names its own length and digest
        head, body = r["header"], bytes(r["payload"])
        assert head.startswith("WARC/1.1\r\n") and head.endswith("\r\n\r\n") and head.count("\r\n\r\n") == 2
        assert f"sha1:{hashlib.sha1(body).hexdigest()}" in head
        http = head.split("\r\n\r\n")[1] + "\r\n\r\n"
        size = len(http) + (0 if "WARC-Type: revisit" in head else len(body))
        assert f"Content-Length: {size}\r\n\r\n" in head


def test_damaged_payload_is_noticed(spark):
    stored = warc.archive(_pages(spark, _rows()[-3:]))
    broken = stored._replace(payloads=stored.payloads.selectExpr("sha256", "concat(payload, cast('!' as binary)) AS payload"))
    with pytest.raises(Exception, match="lost or damaged"):
        warc.records(broken).collect()
    with pytest.raises(Exception, match="lost or damaged"):
        warc.records(stored._replace(payloads=stored.payloads.limit(0))).collect()


@pytest.mark.parametrize("compression", ["gzip", "none"])
def test_warc_files_round_trip(spark, compression):
    stored = warc.archive(_pages(spark, _rows()))
    recs = warc.records(stored)
    path = tempfile.mkdtemp(prefix="cropflow-warc-") + "/files"
    warc.export(recs, path, compression)
    want = sorted((r["header"], b"" if "WARC-Type: revisit" in r["header"] else bytes(r["payload"])) for r in recs.collect())
    for chunk in (1 << 20, 97):
        back = warc.read_files(spark, path, chunk, 10_000).collect()
        assert sorted((r["header"], bytes(r["payload"])) for r in back) == want


def test_reads_files_of_one_gzip_member_per_record(spark):
    path = tempfile.mkdtemp(prefix="cropflow-warc-")
    one = "warc/1.0\r\nWARC-Type: resource\r\nContent-length:  5\r\n\r\nab\n\r\n\r\n\r\n".encode()
    two = "WARC/1.0\r\nWARC-Type: metadata\r\nContent-Length: 0\r\n\r\n\r\n\r\n".encode()
    with open(path + "/a.warc.gz", "wb") as f:
        f.write(gzip.compress(one) + gzip.compress(two) + gzip.compress(one))
    got = sorted((r["header"][:8], bytes(r["payload"])) for r in warc.read_files(spark, path, 16).collect())
    assert got == [("WARC/1.0", b""), ("warc/1.0", b"ab\n\r\n"), ("warc/1.0", b"ab\n\r\n")]
