"""CSV ingest (A01-A12, B02) and its streaming form, on files made in a fresh temp folder."""

import os
from datetime import datetime, timezone

from pyspark.sql import functions as F

from cropflow.sources import csv_ingest
from cropflow.streaming import ingest as stream_ingest

HEADER = ('Area Code,Area Code (M49),Area,Item Code,Item Code (CPC),Item,Element Code,Element,'
          'Year Code,Year,Unit,Value,Flag,Note\n')
ROWS = [
    '4,\'004,Afghanistan,15,\'0111,Wheat,5510,Production,2020,2020,t,"1,234",,\n',
    '4,\'004,Afghanistan,15,\'0111,Wheat,5312,Area harvested,2020,2020,ha, 12 , A ,\n',
    '5000,,World,15,\'0111,Wheat,5510,Production,2020,2020,t,1.5,\tE\t,"say ""hi"", ok"\n',
    '8,\'008,Albania,15,\'0111,Wheat,5510,Production,NA,1.5,t,NA,M,\n',
]


def write_csv(folder, name, text, encoding="utf-8"):
    path = os.path.join(folder, name)
    with open(path, "w", encoding=encoding) as f:
        f.write(text)
    return path


def test_column_cleanup():
    assert csv_ingest.clean_column_name(" Area Code (M49) ") == "Area_Code_M49"
    assert csv_ingest.clean_column_name("Item Code (CPC)") == "Item_Code_CPC"
    assert csv_ingest.clean_column_name("a-b/c, d") == "a_b_c_d"


def test_schema_from_json_and_type_map():
    s = csv_ingest.schema_from_json('[{"name": "Year", "type": "INT64", "mode": "REQUIRED"},'
                                    ' {"name": "Value", "type": "FLOAT64"},'
                                    ' {"name": "X", "type": "GEOGRAPHY"}]')
    assert [f.dataType.simpleString() for f in s.fields] == ["bigint", "double", "string"]
    assert s.fields[0].nullable is False and s.fields[1].nullable is True


def test_load_prepare_align(spark, tmpdir_fresh):
    path = write_csv(tmpdir_fresh, "prod.csv", HEADER + "".join(ROWS))
    ts = datetime(2024, 6, 30, tzinfo=timezone.utc)
    df = csv_ingest.load_csv(spark, path, "prod.csv", loaded_at=ts)
    rows = {(r.Area_Code, r.Element_Code, r.Year): r for r in df.collect()}
    assert len(rows) == 4
    r = rows[(4, 5510, 2020)]
    assert r.Value is None and r.Flag == ""            # '1,234' -> NULL (as coded); NaN flag -> ''
    assert rows[(4, 5312, 2020)].Value == 12.0 and rows[(4, 5312, 2020)].Flag == "A"
    assert rows[(5000, 5510, 2020)].Flag == "E"         # tab-padded flag stripped
    assert rows[(5000, 5510, 2020)].Note == 'say "hi", ok'
    bad = rows[(8, 5510, None)]                         # '1.5' year -> NULL, 'NA' -> NULL
    assert bad.Year_Code is None and bad.Value is None
    from cropflow.sources.driver_tables import RAW_COLUMNS
    from pyspark.sql import types as T
    target = T.StructType([T.StructField(c, T.StringType()) for c in RAW_COLUMNS[:-2]]
                          + [T.StructField("Extra", T.LongType())])
    aligned = csv_ingest.align_to_schema(df, target)
    assert aligned.columns == RAW_COLUMNS[:-2] + ["Extra"]
    assert aligned.where(F.col("Extra").isNotNull()).count() == 0


def test_encoding_detection(spark, tmpdir_fresh):
    utf = write_csv(tmpdir_fresh, "u.csv", HEADER + ROWS[0].replace("Afghanistan", "Côte"))
    lat = write_csv(tmpdir_fresh, "l.csv", HEADER + ROWS[0].replace("Afghanistan", "Côte"), "latin-1")
    assert csv_ingest.detect_encoding(spark, utf) == "utf-8"
    assert csv_ingest.detect_encoding(spark, lat) == "latin-1"
    df = csv_ingest.load_csv(spark, lat, "l.csv")
    assert df.first().Area == "Côte"


def test_write_and_reconcile(spark, tmpdir_fresh):
    path = write_csv(tmpdir_fresh, "p.csv", HEADER + "".join(ROWS))
    df = csv_ingest.load_csv(spark, path, "p.csv")
    out = os.path.join(tmpdir_fresh, "raw")
    csv_ingest.write_table(df, out)
    loaded = spark.read.parquet(out)
    rec = csv_ingest.reconcile(df, loaded, "production").first()
    assert (rec.source_rows, rec.loaded_rows, rec.difference, rec.status) == (4, 4, 0, "PASS")
    short = csv_ingest.reconcile(df, loaded.limit(3), "production").first()
    assert short.status == "FAIL" and short.diff_pct == 25.0
    empty = csv_ingest.reconcile(df.limit(0), loaded.limit(0), "x").first()
    assert empty.diff_pct == 100.0 and empty.status == "FAIL"
    csv_ingest.write_report(csv_ingest.reconcile(df, loaded, "production"),
                            os.path.join(tmpdir_fresh, "report"))


def test_streaming_ingest_matches_batch(spark, tmpdir_fresh):
    landing = os.path.join(tmpdir_fresh, "landing")
    os.makedirs(landing)
    write_csv(landing, "a.csv", HEADER + "".join(ROWS[:2]))
    write_csv(landing, "b.csv", HEADER + "".join(ROWS[2:]))
    table = os.path.join(tmpdir_fresh, "table")
    q = stream_ingest.start_ingest(spark, landing, table, "test",
                                   checkpoint_root=os.path.join(tmpdir_fresh, "ckpt"))
    q.awaitTermination(120)
    got = spark.read.parquet(table)
    assert got.count() == 4
    assert sorted(r._source_file for r in got.select("_source_file").distinct().collect()) == ["a.csv", "b.csv"]
    assert got.where("Area_Code = 4 AND Element_Code = 5312").first().Value == 12.0


def test_file_md5_streams_in_chunks(spark, tmpdir_fresh):
    import hashlib
    import os

    from cropflow.functions.files import md5_of
    from cropflow.operators.checks import file_checks
    p = os.path.join(tmpdir_fresh, "blob.csv")
    data = os.urandom(300_001)
    with open(p, "wb") as f:
        f.write(data)
    want = hashlib.md5(data).hexdigest()
    assert md5_of(p, chunk=4096) == want
    df = file_checks(spark, [p], with_md5=True)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<path:string,length:bigint>" in plan  # no file body in a row
    r = df.first()
    assert (r.md5, r.bytes, r.status) == (want, 300_001, "PASS")


def test_encoding_report_counts_invalid_bytes(spark, tmpdir_fresh):
    import os

    from cropflow.sources.encoding import encoding_report
    good, bad = os.path.join(tmpdir_fresh, "good.csv"), os.path.join(tmpdir_fresh, "bad.csv")
    with open(good, "wb") as f:
        f.write("Area,Value\nCôte d'Ivoire,1\n".encode("utf-8"))
    with open(bad, "wb") as f:
        f.write("Area,Value\nCôte d'Ivoire,1\nok,2\nTürkiye,3\n".encode("latin-1"))
    rows = {r.dataset: r for r in encoding_report(spark, good, "good")
            .unionByName(encoding_report(spark, bad, "bad")).collect()}
    assert (rows["good"].invalid_bytes, rows["good"].encoding) == (0, "utf-8")
    assert (rows["bad"].invalid_bytes, rows["bad"].encoding) == (2, "latin-1")
