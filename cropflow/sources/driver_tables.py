"""Raw observation tables derived from the driver's TPC-H-like tables.

The pipeline expects three long tables (production, trade, food balance)
with the raw column layout ``Area_Code ... Flag, _loaded_at, _source_file``.
This module derives them from ``lineitem/part/supplier/nation/region`` and
``orders/customer`` so every model runs unchanged and its work grows with
the inputs:

* base (lineitem x part x supplier) grouped by nation, brand, ship year,
  return flag and line status: sums of quantity, price (integer cents) and line
  numbers;
* area = nationkey + 1 (countries), 1000 + regionkey (regional sums),
  5000 (world sum) and 999 (a copy of area 1: the country-cut-off edge);
* production: return flag A / N / R -> area harvested / yield / production;
* trade: (A,F) / (A,O) quantities, (N,F) / (N,O) values, (R,*) quantities of
  trade-only items (item + 100);
* food balance: orders x customer by nation and order year, eight elements
  of the grand-total item 2901 plus one element of item 2511.

Scale: the only large inputs are lineitem and orders. Both are reduced by a
grouped aggregation whose key space is bounded by the domain (nations x
brands x years x flags); everything after that is small. The joins to part
/ supplier / customer are left to Catalyst and AQE: broadcast when the
scan's size proves it small, sort-merge otherwise, with AQE splitting hot
join keys; the same holds for nation and region.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import ledger

# Quality flag picked by (line-number sum % 8) for country rows.
ADAPTER_FLAGS = ["", "A", "E", "M", "F", "B", "I", "R"]
AGGREGATE_FLAG = "A"
PRODUCTION_YEAR_SHIFT = 10
FBS_YEAR_SHIFT = 15
TERRITORY_AREA = 999
TERRITORY_SOURCE_AREA = 1
REGION_AREA_BASE = 1000
WORLD_AREA = 5000
LOADED_AT = "2024-06-30 00:00:00"

RAW_COLUMNS = ["Area_Code", "Area_Code_M49", "Area", "Item_Code", "Item_Code_CPC", "Item",
               "Element_Code", "Element", "Year_Code", "Year", "Unit", "Value", "Flag",
               "_loaded_at", "_source_file"]


@dataclass
class RawTables:
    production: DataFrame
    trade: DataFrame
    fbs: DataFrame
    #: ledger of the loads that wrote these tables (None: never written)
    ledger: str | None = None


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


SOURCE_TABLES = ("lineitem", "part", "supplier", "nation", "region", "orders", "customer")


def version(spark: SparkSession, sf_dir: str) -> tuple:
    """Length and modification time of every source table (metadata only): changed files are another version."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    out = []
    for name in SOURCE_TABLES:
        p = jvm.org.apache.hadoop.fs.Path(f"{sf_dir}/{name}.parquet")
        fs = p.getFileSystem(conf)
        out.append((fs.getContentSummary(p).getLength(), fs.getFileStatus(p).getModificationTime()))
    return tuple(out)


# --------------------------------------------------------------------- bases

def _item_of(part: DataFrame) -> DataFrame:
    return part.select(
        "p_partkey",
        F.substr(F.col("p_brand"), F.lit(7)).try_cast("bigint").alias("item_code"),
        F.col("p_brand").alias("item_name"))


def _cents(c: str) -> F.Column:
    """A money amount as exact integer cents: sums stay in 64-bit integers
    (no BigDecimal buffers) and equal the decimal(18,2) sums exactly."""
    return F.round(F.col(c) * 100).cast("bigint")


def lineitem_base(lineitem: DataFrame, part: DataFrame, supplier: DataFrame,
                  year_shift: int = PRODUCTION_YEAR_SHIFT) -> DataFrame:
    """(nationkey, item, year, returnflag, linestatus) -> qty, price, lines."""
    li = lineitem.select(
        "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_linenumber",
        "l_returnflag", "l_linestatus",
        (F.year("l_shipdate") + F.lit(year_shift)).cast("bigint").alias("year"))
    items = _item_of(part)
    sup = supplier.select("s_suppkey", "s_nationkey")
    joined = (li.join(items, li["l_partkey"] == items["p_partkey"])
                .join(sup, li["l_suppkey"] == sup["s_suppkey"]))
    return (joined.groupBy("s_nationkey", "item_code", "item_name", "year",
                           "l_returnflag", "l_linestatus")
            .agg(F.sum("l_quantity").alias("qty"),
                 F.sum(_cents("l_extendedprice")).alias("price_cents"),
                 F.sum("l_linenumber").cast("bigint").alias("lines")))


def orders_base(orders: DataFrame, customer: DataFrame,
                year_shift: int = FBS_YEAR_SHIFT) -> DataFrame:
    """(nationkey, year) -> order count, total price (integer cents)."""
    o = orders.select("o_custkey", "o_totalprice",
                      (F.year("o_orderdate") + F.lit(year_shift)).cast("bigint").alias("year"))
    c = customer.select("c_custkey", F.col("c_nationkey").alias("s_nationkey"))
    joined = o.join(c, o["o_custkey"] == c["c_custkey"])
    return (joined.groupBy("s_nationkey", "year")
            .agg(F.count(F.lit(1)).alias("cnt"),
                 F.sum(_cents("o_totalprice")).alias("tp_cents")))


def with_areas(base: DataFrame, nation: DataFrame, region: DataFrame,
               keys: list[str], measures: list[str]) -> DataFrame:
    """Country rows plus regional, world and territory rows, summed from the countries.

    One pass: every country row is exploded into the areas it belongs to
    (itself, its region, the world, and the territory copy for area 1), then
    a single grouped sum builds all of them. Partial aggregation runs before
    the shuffle, and the key space is bounded (areas x keys).
    """
    nat = nation.select("n_nationkey", "n_name", "n_regionkey")
    reg = region.select("r_regionkey", "r_name")
    j = (base.join(nat, base["s_nationkey"] == nat["n_nationkey"])
         .join(reg, F.col("n_regionkey") == reg["r_regionkey"]))
    area = (F.col("s_nationkey") + 1).cast("bigint")

    def member(code, name, is_agg):
        return F.struct(code.cast("bigint").alias("area_code"), name.alias("area_name"),
                        F.lit(is_agg).alias("is_aggregate"))

    memberships = F.array(
        member(area, F.col("n_name"), False),
        member(F.col("n_regionkey") + REGION_AREA_BASE, F.col("r_name"), True),
        member(F.lit(WORLD_AREA), F.lit("World"), True),
        F.when(area == TERRITORY_SOURCE_AREA,
               member(F.lit(TERRITORY_AREA), F.concat(F.col("n_name"), F.lit(" (territory)")), False)),
    )
    exploded = j.select(F.explode(F.filter(memberships, lambda m: m.isNotNull())).alias("a"),
                        *keys, *measures)
    return (exploded.groupBy(F.col("a.area_code").alias("area_code"),
                             F.col("a.area_name").alias("area_name"),
                             F.col("a.is_aggregate").alias("is_aggregate"), *keys)
            .agg(*[F.sum(m).alias(m) for m in measures]))


# ---------------------------------------------------------------- finishing

def _flag(is_aggregate, lines) -> F.Column:
    pick = F.element_at(F.array(*[F.lit(f) for f in ADAPTER_FLAGS]),
                        (F.pmod(lines, F.lit(8)) + 1).cast("int"))
    return F.when(is_aggregate, F.lit(AGGREGATE_FLAG)).otherwise(pick)


def _finish(long: DataFrame, source_file: str, with_cpc: bool = True) -> DataFrame:
    """long has area_code, area_name, is_aggregate, item_code, item_name,
    element_code, element, unit, value, lines."""
    flag = _flag(F.col("is_aggregate"), F.col("lines"))
    m49 = F.when(F.col("area_code") < 1000, F.lpad(F.col("area_code").cast("string"), 3, "0"))
    cpc = F.lpad(F.col("item_code").cast("string"), 4, "0") if with_cpc else F.lit(None).cast("string")
    return long.select(
        F.col("area_code").alias("Area_Code"),
        m49.alias("Area_Code_M49"),
        F.col("area_name").alias("Area"),
        F.col("item_code").alias("Item_Code"),
        cpc.alias("Item_Code_CPC"),
        F.col("item_name").alias("Item"),
        F.col("element_code").cast("bigint").alias("Element_Code"),
        F.col("element").alias("Element"),
        F.col("year").alias("Year_Code"),
        F.col("year").alias("Year"),
        F.col("unit").alias("Unit"),
        F.when(flag != F.lit("M"), F.col("value").cast("double")).alias("Value"),
        flag.alias("Flag"),
        F.to_timestamp(F.lit(LOADED_AT)).alias("_loaded_at"),
        F.lit(source_file).alias("_source_file"))


def _elements(rows: DataFrame, keep: list[str], elements: list[tuple], item: tuple | None = None,
              more: list[tuple] = (), more_item: tuple | None = None) -> DataFrame:
    """Unpivot: one output row per (element_code, element, unit, value expr, lines expr), and
    per element of a second item; items are (code, name) columns added to their rows."""
    def fields(item):
        return [] if item is None else [F.lit(item[0]).cast("bigint").alias("item_code"), F.lit(item[1]).alias("item_name")]

    structs = [F.struct(F.lit(code).alias("element_code"), F.lit(name).alias("element"),
                        F.lit(unit).alias("unit"), value.cast("double").alias("value"),
                        lines.cast("bigint").alias("lines"), *fields(of))
               for part, of in ((elements, item), (more, more_item)) for code, name, unit, value, lines in part]
    return (rows.select(*keep, F.inline(F.array(*structs)))
            .where(F.col("value").isNotNull()))


def production_raw(area_base: DataFrame, names: dict | None = None) -> DataFrame:
    """Production rows of a base. `names` are columns that follow from the codes (name -> expression):
    they are added after the grouping, so that its hash maps hold the codes alone."""
    names = names or {}
    rf = F.col("l_returnflag")

    def part_sum(flag, m):
        return F.sum(F.when(rf == flag, F.col(m))).alias(f"{m}_{flag.lower()}")

    keys = ["area_code", "area_name", "is_aggregate", "item_code", "item_name", "year"]
    wide = (area_base.where(rf.isin("A", "N", "R")).groupBy(*[k for k in keys if k not in names])
            .agg(*[part_sum(f, m) for f in ("A", "N", "R") for m in ("qty", "lines")])
            .withColumns(names))
    q_a, q_n, q_r, l_n = F.col("qty_a"), F.col("qty_n"), F.col("qty_r"), F.col("lines_n")
    # Reported yield (hg/ha): production / area x 10,000, perturbed by up to +-12 %.
    skew = F.lit(1.0) + (F.pmod(l_n, F.lit(13)) - F.lit(6)) / F.lit(50.0)
    yield_hg = F.when(q_n.isNull(), F.lit(None)).when(
        (q_a > 0) & q_r.isNotNull(), F.floor(q_r * F.lit(10000) / q_a * skew).cast("double")
    ).otherwise(q_n)
    long = _elements(wide, keys, [
        (5312, "Area harvested", "ha", q_a, F.col("lines_a")),
        (5417, "Yield", "hg/ha", yield_hg, l_n),
        (5510, "Production", "t", q_r, F.col("lines_r")),
    ])
    return _finish(long, "driver:lineitem")


def trade_raw(area_base: DataFrame) -> DataFrame:
    rf, ls = F.col("l_returnflag"), F.col("l_linestatus")
    code = (F.when(rf == "N", F.when(ls == "F", F.lit(5622)).otherwise(F.lit(5922)))
            .otherwise(F.when(ls == "F", F.lit(5610)).otherwise(F.lit(5910))))
    element = (F.when(rf == "N", F.when(ls == "F", F.lit("Export Value")).otherwise(F.lit("Import Value")))
               .otherwise(F.when(ls == "F", F.lit("Export Quantity")).otherwise(F.lit("Import Quantity"))))
    unit = F.when(rf == "N", F.lit("1000 USD")).otherwise(F.lit("t"))
    value = F.when(rf == "N", F.col("price_cents") / F.lit(100.0)).otherwise(F.col("qty"))
    # Return flag R rows trade a processed item (code + 100) that production never has.
    item_code = F.when(rf == "R", F.col("item_code") + 100).otherwise(F.col("item_code"))
    item_name = F.when(rf == "R", F.concat(F.col("item_name"), F.lit(" products"))).otherwise(F.col("item_name"))
    long = area_base.select(
        "area_code", "area_name", "is_aggregate", item_code.alias("item_code"),
        item_name.alias("item_name"), "year", code.alias("element_code"),
        element.alias("element"), unit.alias("unit"), value.alias("value"), "lines")
    return _finish(long, "driver:lineitem")


def fbs_raw(area_base: DataFrame) -> DataFrame:
    cnt = F.col("cnt")
    tpf = F.expr("tp_cents div 100")  # floor of the decimal total (amounts are positive)
    kcal = F.lit(1500) + F.pmod(tpf, F.lit(2000)) + F.pmod(cnt, F.lit(2)) * F.lit(0.5)
    keys = ["area_code", "area_name", "is_aggregate", "year"]

    def lines(code):
        return cnt + F.lit(code)

    grand = [
        (664, "Food supply (kcal/capita/day)", "kcal/capita/day", kcal, lines(664)),
        (674, "Protein supply quantity (g/capita/day)", "g/capita/day",
         F.lit(30) + F.pmod(cnt, F.lit(70)), lines(674)),
        (684, "Fat supply quantity (g/capita/day)", "g/capita/day",
         F.lit(20) + F.pmod(cnt * 7, F.lit(90)), lines(684)),
        (5301, "Food supply quantity (kg/capita/yr)", "kg/capita/yr",
         F.lit(100) + F.pmod(cnt, F.lit(150)), lines(5301)),
        (5511, "Production", "1000 t", cnt, lines(5511)),
        (5611, "Import Quantity", "1000 t", F.pmod(tpf, F.lit(1000)), lines(5611)),
        (5911, "Export Quantity", "1000 t", F.pmod(cnt, F.lit(50)), lines(5911)),
        (5072, "Domestic supply quantity", "1000 t",
         cnt + F.pmod(tpf, F.lit(1000)) - F.pmod(cnt, F.lit(50)), lines(5072)),
    ]
    wheat = [(5511, "Production", "1000 t", F.pmod(cnt, F.lit(100)), lines(5511))]
    # both items unpivot in one pass over the base
    rows = _elements(area_base, keys, grand, (2901, "Grand Total"), wheat, (2511, "Wheat and products"))
    return _finish(rows, "driver:orders", with_cpc=False)


def monthly_production(spark: SparkSession, sf_dir: str, year_shift: int = PRODUCTION_YEAR_SHIFT,
                       country_max: int = 999) -> DataFrame:
    """Production (return flag R) of country areas per month: the series the
    trend operator runs on when 10 periods must fit in the data span.
    period = yyyymm of the shifted ship date."""
    t = {n: read_table(spark, sf_dir, n) for n in ("lineitem", "part", "supplier")}
    li = t["lineitem"].where(F.col("l_returnflag") == "R").select(
        "l_partkey", "l_suppkey", "l_quantity",
        ((F.year("l_shipdate") + year_shift) * 100 + F.month("l_shipdate")).cast("bigint").alias("period"))
    items = _item_of(t["part"])
    sup = t["supplier"].select("s_suppkey", "s_nationkey")
    j = li.join(items, li["l_partkey"] == items["p_partkey"]).join(sup, li["l_suppkey"] == sup["s_suppkey"])
    area = (F.col("s_nationkey") + 1).cast("bigint")
    return (j.where(area < country_max)
            .groupBy(area.alias("area_code"), "item_code", "item_name", "period")
            .agg(F.sum("l_quantity").alias("production_tonnes")))


def area_bases(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """(lineitem area base, orders area base) as lazy DataFrames."""
    t = {n: read_table(spark, sf_dir, n)
         for n in ("lineitem", "part", "supplier", "nation", "region", "orders", "customer")}
    li_keys = ["item_code", "item_name", "year", "l_returnflag", "l_linestatus"]
    li_area = with_areas(lineitem_base(t["lineitem"], t["part"], t["supplier"]),
                         t["nation"], t["region"], li_keys, ["qty", "price_cents", "lines"])
    o_area = with_areas(orders_base(t["orders"], t["customer"]),
                        t["nation"], t["region"], ["year"], ["cnt", "tp_cents"])
    return li_area, o_area


def fine_production(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The production long table at its finest grain: area = supplier, item = part.

    Its rows grow with lineitem (about one per line item), so staging, pivots,
    tests and statistics run on data of any size; no join is needed. Line items
    are grouped once, by three numbers: a group per flag before the pivot would
    reduce next to nothing and hold a second hash map in the same task.
    """
    li = read_table(spark, sf_dir, "lineitem")
    rows = li.select(
        F.col("l_suppkey").alias("area_code"), F.col("l_partkey").alias("item_code"),
        (F.year("l_shipdate") + F.lit(PRODUCTION_YEAR_SHIFT)).cast("bigint").alias("year"), "l_returnflag",
        F.col("l_quantity").alias("qty"), F.col("l_linenumber").alias("lines"))
    return production_raw(rows, names={
        "area_name": F.concat(F.lit("Supplier "), F.col("area_code").cast("string")),
        "is_aggregate": F.lit(False),
        "item_name": F.concat(F.lit("Part "), F.col("item_code").cast("string"))})


def raw_tables(spark: SparkSession, sf_dir: str) -> RawTables:
    """The three raw long tables as lazy DataFrames."""
    li_area, o_area = area_bases(spark, sf_dir)
    return RawTables(production=production_raw(li_area), trade=trade_raw(li_area),
                     fbs=fbs_raw(o_area))


def write_raw_layer(spark: SparkSession, sf_dir: str, out_dir: str,
                    extra: dict[str, DataFrame] | None = None) -> tuple[RawTables, dict]:
    """Build the raw layer once, write it as Parquet under `out_dir` (a shared
    folder) and return DataFrames reading the written tables, plus the
    written `extra` tables (e.g. the seeds).

    Independent tables are written by concurrent jobs (Spark schedules jobs
    from several driver threads), so a scan with few splits does not leave
    cores idle. The lineitem base feeds two tables and is persisted for the
    two writes (recomputed from lineage if an executor holding it is lost).
    """
    from concurrent.futures import ThreadPoolExecutor

    li_area, o_area = area_bases(spark, sf_dir)
    out_dir = out_dir.rstrip("/")

    lines: dict[str, tuple] = {}

    def write(name: str, df: DataFrame) -> DataFrame:
        # rows are counted and hashed while they are written (no second build to reconcile against)
        target = f"{out_dir}/{name}"
        lines[name] = (name, *ledger.observed_write(df, target, name), target)
        return spark.read.parquet(target)

    def lineitem_tables() -> dict:
        li = li_area.persist()
        try:
            return {"production": write("production", production_raw(li)),
                    "trade": write("trade", trade_raw(li))}
        finally:
            li.unpersist()

    jobs = {"fbs": lambda: write("fbs", fbs_raw(o_area))}
    for name, df in (extra or {}).items():
        jobs[name] = (lambda n, d: lambda: write(n, d))(name, df)
    with ThreadPoolExecutor(max_workers=1 + len(jobs)) as pool:
        li_future = pool.submit(lineitem_tables)
        futures = {name: pool.submit(fn) for name, fn in jobs.items()}
        tables = li_future.result()
        written = {name: f.result() for name, f in futures.items()}
    book = f"{out_dir}/_ledger"
    ledger.append(spark, book, [lines[t] for t in ("production", "trade", "fbs")])
    raw = RawTables(production=tables["production"], trade=tables["trade"], fbs=written.pop("fbs"), ledger=book)
    return raw, written
