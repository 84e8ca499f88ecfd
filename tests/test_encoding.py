"""Encoding detection on bytes: any cuts, marks, and loads of each encoding."""

import os
import tempfile

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from cropflow.sources import csv_ingest, encoding


def _file(data: bytes) -> str:
    path = tempfile.mkdtemp(prefix="cropflow-bytes-") + "/f.csv"
    with open(path, "wb") as f:
        f.write(data)
    return path


def _plain(data: bytes):
    """Bytes outside well-formed characters, one position at a time."""
    bad, i = [], 0
    while i < len(data):
        for n in (1, 2, 3, 4):
            try:
                if len(data[i : i + n].decode()) == 1:
                    i += n
                    break
            except UnicodeDecodeError:
                continue
        else:
            bad.append(i)
            i += 1
    return len(bad), bad[0] if bad else None


pieces = st.lists(st.sampled_from([b"a", b"\n", "é".encode(), "日".encode(), "🙂".encode(), b"\xe9", b"\xa0", b"\xf0\x9f", b"\xe0\x80", b"\xff", b"\xed\xa0\x80", b"\xc0\xaf"]), max_size=40)


@settings(max_examples=300, deadline=None)
@given(pieces)
def test_malformed_bytes(parts):
    data = b"".join(parts)
    assert encoding.malformed(data)[:2] == _plain(data)


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(pieces, min_size=12, max_size=12), st.sampled_from([4, 5, 7]))
def test_any_cuts_give_the_same_answer(spark, files, size):
    folder = tempfile.mkdtemp(prefix="cropflow-bytes-")
    for k, parts in enumerate(files):
        with open(f"{folder}/f{k}", "wb") as f:
            f.write(b"".join(parts))
    for r in encoding.scan_files(spark, folder, size).collect():
        data = b"".join(files[int(os.path.basename(r["path"])[1:])])
        assert (r["bytes"], r["invalid_bytes"], r["first_invalid"]) == (len(data), *_plain(data))


@pytest.mark.parametrize("charset, mark, found", [
    ("utf-8", b"", "utf-8"), ("utf-8", b"\xef\xbb\xbf", "utf-8"), ("latin-1", b"", "latin-1"),
    ("utf-16-le", b"\xff\xfe", "utf-16"), ("utf-16-be", b"\xfe\xff", "utf-16")])
@pytest.mark.parametrize("size", [4, 1 << 20])
def test_files_load_alike_in_every_encoding(spark, charset, mark, found, size):
    text = 'Area Code,Area,Value,Flag\n1,"Côte d\'Ivoire, ñ",2.5,\n2,Österreich,3,A\n'
    path = _file(mark + text.encode(charset))
    report = encoding.encoding_report(spark, path, "x", size).first()
    assert report["encoding"] == found and report["has_bom"] == bool(mark)
    got = csv_ingest.load_csv(spark, path, "f.csv").select("Area_Code", "Area", "Value", "Flag").collect()
    assert [tuple(r) for r in got] == [(1, "Côte d'Ivoire, ñ", 2.5, ""), (2, "Österreich", 3.0, "A")]


def test_empty_file(spark):
    path = _file(b"")  # Spark lists no empty file
    assert encoding.scan_files(spark, path).count() == 0
    assert tuple(encoding.encoding_report(spark, path, "x").first()) == ("x", False, 0, "utf-8")
