"""Raw validation checks.

Each check yields rows (dataset, check, status, detail), status in
PASS / WARN / FAIL. In the suite the data checks of one dataset share one
global aggregate, and the key check a group-by on the key columns (the only
shuffle, carrying keys and a count); a check asked for alone runs its own
aggregate only. A column that is absent gives a FAIL row of the column check
and a WARN row of the check that looks at it. Rows come from `inline`, all
JVM-side; nothing is collected.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.core import trim_ws
from ..functions.files import file_md5


@dataclass(frozen=True)
class DatasetSpec:
    name: str
    expected_columns: tuple
    expected_elements: tuple
    year_min: int
    year_max: int
    min_rows: int
    max_negative_pct: float


# Required raw columns (after the name clean-up) and the
# per-dataset expectations of the raw checks.
RAW_REQUIRED = ("Area_Code", "Area", "Item_Code", "Item", "Element_Code", "Element",
                "Year_Code", "Year", "Unit", "Value", "Flag")
OPTIONAL_COLUMNS = ("Note", "Area_Code_M49", "Item_Code_CPC")
KEY_COLUMNS = ("Area_Code", "Item_Code", "Element_Code", "Year")

SPECS = {
    "production": DatasetSpec("production", RAW_REQUIRED,
                              ("Production", "Area harvested", "Yield"),
                              1961, 2022, 1_000_000, 0.01),
    "trade": DatasetSpec("trade", RAW_REQUIRED,
                         ("Export Quantity", "Export Value", "Import Quantity", "Import Value"),
                         1986, 2022, 500_000, 0.01),
    "fbs": DatasetSpec("fbs", RAW_REQUIRED,
                       ("Food supply (kcal/capita/day)", "Protein supply quantity (g/capita/day)",
                        "Fat supply quantity (g/capita/day)"),
                       2010, 2022, 50_000, 0.05),
}

CHECK_SCHEMA = "dataset string, check string, status string, detail string"


def _row(dataset: str, check: str, status: Column, detail: Column) -> Column:
    return F.struct(F.lit(dataset).alias("dataset"), F.lit(check).alias("check"),
                    status.alias("status"), detail.cast("string").alias("detail"))


def _s(c) -> Column:
    return F.col(c).cast("string")


def columns_check(df: DataFrame, spec: DatasetSpec) -> tuple[str, str]:
    """(status, detail) from the schema alone (metadata, no data read)."""
    actual = {c.strip() for c in df.columns}
    missing = sorted(set(spec.expected_columns) - actual)
    extra = sorted(actual - set(spec.expected_columns) - set(OPTIONAL_COLUMNS)
                   - {"_loaded_at", "_source_file"})
    if missing:
        return "FAIL", "missing=" + ",".join(missing)
    return "PASS", "extra=" + ",".join(extra)


def _has(df: DataFrame, *names: str) -> bool:
    return set(names) <= set(df.columns)


def _key_figures(df: DataFrame) -> DataFrame:
    """Rows and distinct keys: the one shuffle of the suite carries keys and a count only."""
    keys = [c for c in KEY_COLUMNS if c in df.columns]
    if not keys:
        return df.agg(F.count(F.lit(1)).alias("rows"), F.lit(0).cast("long").alias("distinct_keys"))
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return per_key.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("rows"), F.count(F.lit(1)).alias("distinct_keys"))


def _figures(df: DataFrame, spec: DatasetSpec, name: str) -> list[Column]:
    """Global aggregates one check needs; none if the column it looks at is absent."""
    if name == "ROW_COUNT":
        return [F.count(F.lit(1)).alias("n")]
    if name == "YEAR_RANGE" and _has(df, "Year"):
        return [F.min("Year").alias("min_year"), F.max("Year").alias("max_year")]
    if name == "ELEMENTS_PRESENT" and _has(df, "Element"):
        return [F.max(F.lower(F.col("Element")).contains(e.lower()).cast("int")).alias(f"el_{i}")
                for i, e in enumerate(spec.expected_elements)]
    if name == "NEGATIVE_VALUES" and _has(df, "Value"):
        return [F.count("Value").alias("nn"), F.count_if(F.col("Value") < 0).alias("neg")]
    if name == "FLAG_DIST" and _has(df, "Flag"):
        flag = F.upper(trim_ws(F.coalesce(F.col("Flag").cast("string"), F.lit(""))))
        return [F.count(F.lit(1)).alias("flags"), F.count_if(flag == "M").alias("m"), F.count_if(flag == "").alias("official")]
    if name == "AREA_TYPES" and _has(df, "Area_Code"):
        area = F.col("Area_Code")
        return [F.count_if(area < 1000).alias("countries"), F.count_if(area >= 1000).alias("aggs")]
    return []


# The column each check looks at; its absence is a warning of that check.
LOOKS_AT = {"YEAR_RANGE": "Year", "ELEMENTS_PRESENT": "Element", "NEGATIVE_VALUES": "Value",
            "FLAG_DIST": "Flag", "AREA_TYPES": "Area_Code"}
CHECKS = ("COLUMNS_PRESENT", "ROW_COUNT", "PK_UNIQUENESS", *LOOKS_AT)


def _result(df: DataFrame, spec: DatasetSpec, name: str) -> Column:
    """The (dataset, check, status, detail) struct of one check over its figures."""
    c = F.col
    if name in LOOKS_AT and not _has(df, LOOKS_AT[name]):
        return _row(spec.name, name, F.lit("WARN"), F.lit(f"no column {LOOKS_AT[name]}"))
    if name == "COLUMNS_PRESENT":
        status, detail = columns_check(df, spec)
        return _row(spec.name, name, F.lit(status), F.lit(detail))
    if name == "ROW_COUNT":
        return _row(spec.name, name, F.when(c("n") >= spec.min_rows, "PASS").otherwise("FAIL"),
                    F.concat(F.lit("rows="), _s("n"), F.lit(f" min={spec.min_rows}")))
    if name == "PK_UNIQUENESS":
        dups = c("rows") - c("distinct_keys")
        if len([k for k in KEY_COLUMNS if k in df.columns]) < 3:
            return _row(spec.name, name, F.lit("WARN"), F.lit("fewer than three key columns"))
        return _row(spec.name, name, F.when(dups == 0, "PASS").otherwise("FAIL"),
                    F.concat(F.lit("duplicates="), dups.cast("string"), F.lit(" rows="), _s("rows")))
    if name == "YEAR_RANGE":
        return _row(spec.name, name,
                    F.when((c("min_year") <= spec.year_min) & (c("max_year") >= spec.year_max), "PASS").otherwise("WARN"),
                    F.concat(F.lit("years="), F.coalesce(_s("min_year"), F.lit("")), F.lit("-"), F.coalesce(_s("max_year"), F.lit("")),
                             F.lit(f" required={spec.year_min}-{spec.year_max}")))
    if name == "ELEMENTS_PRESENT":
        missing = F.concat_ws(", ", *[F.when(F.coalesce(c(f"el_{i}"), F.lit(0)) == 0, F.lit(e))
                                      for i, e in enumerate(spec.expected_elements)])
        return _row(spec.name, name, F.when(missing == "", "PASS").otherwise("WARN"), F.concat(F.lit("missing="), missing))
    if name == "NEGATIVE_VALUES":
        share = F.try_divide(c("neg"), c("nn"))
        return _row(spec.name, name, F.when(c("nn") == 0, "WARN").when(share <= spec.max_negative_pct, "PASS").otherwise("FAIL"),
                    F.concat(F.lit("negative="), _s("neg"), F.lit(" non_null="), _s("nn")))
    if name == "FLAG_DIST":
        pct = F.try_divide(c("m") * F.lit(100.0), c("flags"))
        return _row(spec.name, name, F.when(pct > 50, "FAIL").when(pct > 30, "WARN").otherwise("PASS"),
                    F.concat(F.lit("missing="), _s("m"), F.lit(" official="), _s("official"), F.lit(" rows="), _s("flags")))
    return _row(spec.name, name, F.when((c("countries") > 0) & (c("aggs") > 0), "PASS").when(c("aggs") == 0, "WARN").otherwise("FAIL"),
                F.concat(F.lit("countries="), _s("countries"), F.lit(" aggregates="), _s("aggs")))


def one_check(df: DataFrame, spec: DatasetSpec, name: str) -> DataFrame:
    """A single check (B03-B10) with only its own aggregate; B03 reads no rows."""
    if name == "PK_UNIQUENESS":
        figures = _key_figures(df)
    else:
        aggs = _figures(df, spec, name)
        figures = df.agg(*aggs) if aggs else df.limit(0).agg(F.count(F.lit(1)).alias("n"))
    return figures.select(F.inline(F.array(_result(df, spec, name))))


def dataset_checks(df: DataFrame, spec: DatasetSpec) -> DataFrame:
    """B03-B10 for one dataset, one row per check: one global aggregate and one
    key count, whose two numbers enter as a scalar subquery."""
    aggs = [a for name in CHECKS for a in _figures(df, spec, name)]
    keyed = _key_figures(df).select(F.struct("rows", "distinct_keys").alias("k")).scalar()
    figures = df.agg(*aggs).select("*", keyed["rows"].alias("rows"), keyed["distinct_keys"].alias("distinct_keys"))
    return figures.select(F.inline(F.array(*[_result(df, spec, name) for name in CHECKS])))


def validate_file(spark: SparkSession, path: str, spec: DatasetSpec, min_mb: float = 0.1, read=None) -> DataFrame:
    """B13 for one CSV file (or folder of parts): existence and size, encoding, load, then B03-B10.

    Stops early: an absent or too small file, or one without rows, gives that FAIL row alone.
    """
    from ..sources import csv_ingest, encoding
    size = path_bytes(spark, path)
    row = lambda check, status, detail: spark.createDataFrame([(spec.name, check, status, detail)], CHECK_SCHEMA)
    if size is None:
        return row("FILE_EXISTS", "FAIL", "not found")
    if size < min_mb * 1024 * 1024:
        return row("FILE_SIZE", "FAIL", f"bytes={size}")
    found = encoding.detect_encoding(spark, path)
    head = row("FILE_EXISTS", "PASS", "").unionByName(row("ENCODING", "PASS", found))
    df = (read or csv_ingest.load_csv)(spark, path, spec.name)
    if df.isEmpty():
        return head.unionByName(row("LOAD", "FAIL", "no rows"))
    return head.unionByName(dataset_checks(df, spec))


def path_bytes(spark: SparkSession, path: str) -> int | None:
    """Bytes of a file or of the files under a folder, None if it does not exist (metadata only)."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.getContentSummary(p).getLength() if fs.exists(p) else None


def validation_suite(tables: dict[str, DataFrame], specs: dict = SPECS) -> DataFrame:
    """The checks of every dataset, unioned."""
    out = None
    for name, df in tables.items():
        part = dataset_checks(df, specs[name])
        out = part if out is None else out.unionByName(part)
    return out


def validation_summary(checks: DataFrame) -> DataFrame:
    """Passed / failed / warnings per dataset, valid iff no FAIL; the row ALL holds
    the totals and is valid (ready to load) iff every dataset is."""
    st = F.col("status")
    counts = checks.rollup("dataset").agg(
        F.count_if(st == "PASS").alias("passed"),
        F.count_if(st == "FAIL").alias("failed"),
        F.count_if(st == "WARN").alias("warnings"),
        (F.count_if(st == "FAIL") == 0).alias("is_valid"))
    return counts.withColumn("dataset", F.coalesce("dataset", F.lit("ALL")))


def file_checks(spark: SparkSession, paths: list[str], min_mb: float = 0.1,
                with_md5: bool = False) -> DataFrame:
    """B01 (exists and >= min_mb) and, optionally, B11 (MD5 of each file).

    `binaryFile` is read for path and length only (its `content` column is
    never selected, so no file body is loaded). The digest streams each file
    in fixed-size chunks inside a task (`functions.files.file_md5`), so it
    has no 2 GB row limit and constant memory; non-splittable files larger
    than a split already sit one per partition. An absent path is a FAIL row.
    """
    absent = [p for p in paths if path_bytes(spark, p) is None]
    found = [p for p in paths if p not in absent]
    if absent:
        rows = spark.createDataFrame([(p, None, "FAIL", None) for p in absent],
                                     "path string, bytes long, status string, md5 string")
        rows = rows if with_md5 else rows.drop("md5")
        return rows.unionByName(file_checks(spark, found, min_mb, with_md5)) if found else rows
    df = spark.read.format("binaryFile").load(paths)
    size_mb = F.col("length") / F.lit(1024.0 * 1024.0)
    cols = [F.regexp_replace("path", "^file:", "").alias("path"), F.col("length").alias("bytes"),
            F.when(size_mb >= min_mb, "PASS").otherwise("FAIL").alias("status")]
    if with_md5:
        cols.append(file_md5(F.col("path")).alias("md5"))
    return df.select(*cols)
