"""The model DAG as lazily composed DataFrames.

    raw x3 -> staging (M01-M03) -> wide (M04-M06) -> dims (M07-M10)
           -> facts (M11-M13) -> reports (M14-M17)

`Models` builds each node once, so every consumer shares the same DataFrame.
Staging and intermediate models are views (lazy DataFrames). Dimensions,
facts and reports are tables: given a store folder they are written as
Parquet on first use and read back, which cuts lineage as the reference's
table materialisations do; `materialize` writes all of them at once to a
chosen warehouse folder.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from ..config import DEFAULT, Config
from ..session import checkpoint_dir, shared_path
from ..operators import dims, facts, pivots, reports, staging
from ..sources import driver_tables, seeds


@dataclass
class Inputs:
    raw: driver_tables.RawTables
    regions_seed: DataFrame
    commodity_seed: DataFrame


_INPUTS: dict[tuple, Inputs] = {}
_MODELS: dict[tuple, "Models"] = {}


def _seeds(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Seeds derived from the driver's tables, one selection of commodities per run."""
    def t(name):
        return driver_tables.read_table(spark, sf_dir, name)

    return {"seed_regions": seeds.region_seed(t("nation"), t("region")),
            "seed_commodities": seeds.commodity_seed(t("part"))}


def _lazy_inputs(spark: SparkSession, sf_dir: str) -> Inputs:
    s = _seeds(spark, sf_dir)
    return Inputs(raw=driver_tables.raw_tables(spark, sf_dir),
                  regions_seed=s["seed_regions"], commodity_seed=s["seed_commodities"])


def driver_inputs(spark: SparkSession, sf_dir: str, materialize_raw: bool = True) -> Inputs:
    """Raw layer + seeds for `sf_dir`.

    With a shared folder configured (`spark.checkpoint.dir`), the raw tables
    and the seeds are built once per application, written there as Parquet
    (the warehouse raw layer) and read back, which also cuts their lineage.
    Without one, everything stays lazy.
    """
    base = checkpoint_dir(spark) if materialize_raw else None
    if not base:
        return _lazy_inputs(spark, sf_dir)
    key = (spark.sparkContext.applicationId, sf_dir, driver_tables.version(spark, sf_dir), base)
    if key not in _INPUTS:
        out = f"{base.rstrip('/')}/cropflow-raw/{uuid.uuid4().hex}"
        raw, seeds_ = driver_tables.write_raw_layer(spark, sf_dir, out,
                                                    extra=_seeds(spark, sf_dir))
        _INPUTS[key] = Inputs(raw=raw, regions_seed=seeds_["seed_regions"],
                              commodity_seed=seeds_["seed_commodities"])
    return _INPUTS[key]


def raw_layer(spark: SparkSession, sf_dir: str) -> driver_tables.RawTables:
    return driver_inputs(spark, sf_dir).raw


def stored_raw(spark: SparkSession, sf_dir: str, raw: driver_tables.RawTables) -> driver_tables.RawTables:
    """The raw layer as loaded tables with their ledger; a lazy one is loaded first."""
    if raw.ledger:
        return raw
    return driver_tables.write_raw_layer(spark, sf_dir, shared_path(spark, "cropflow-raw"))[0]


def stored(build):
    """A model materialised as a table: with a store folder, it is written as
    Parquet on first use and every consumer reads the table (dbt `table`);
    without one it stays a lazy view."""
    name = build.__name__

    def get(self):
        if name not in self.__dict__:
            df = build(self)
            if self.store_dir:
                path = f"{self.store_dir.rstrip('/')}/{name}"
                df.write.mode("overwrite").option("compression", "snappy").parquet(path)
                df = self.spark.read.parquet(path)
            self.__dict__[name] = df
        return self.__dict__[name]

    get.__name__ = name
    get.__doc__ = build.__doc__
    return property(get)


class Models:
    def __init__(self, spark: SparkSession, inputs: Inputs, cfg: Config = DEFAULT,
                 overrides: dict | None = None, store_dir: str | None = None):
        self.spark = spark
        self.inputs = inputs
        self.cfg = cfg
        self.store_dir = store_dir
        for name, df in (overrides or {}).items():  # materialised tables replace nodes
            self.__dict__[name] = df

    # staging
    @cached_property
    def stg_production(self) -> DataFrame:
        return staging.stage_production(self.inputs.raw.production, self.cfg)

    @cached_property
    def stg_trade(self) -> DataFrame:
        return staging.stage_trade(self.inputs.raw.trade, self.cfg)

    @cached_property
    def stg_fbs(self) -> DataFrame:
        return staging.stage_fbs(self.inputs.raw.fbs, self.cfg)

    # intermediate
    @cached_property
    def int_production(self) -> DataFrame:
        return pivots.pivot_production(self.stg_production, self.cfg)

    @cached_property
    def int_trade(self) -> DataFrame:
        return pivots.pivot_trade(self.stg_trade, self.stg_production, self.cfg)

    @cached_property
    def int_food_security(self) -> DataFrame:
        return pivots.pivot_fbs(self.stg_fbs, self.cfg)

    # dimensions
    @stored
    def dim_area(self) -> DataFrame:
        return dims.dim_area(self.stg_production, self.stg_trade, self.stg_fbs,
                             self.inputs.regions_seed)

    @stored
    def dim_item(self) -> DataFrame:
        return dims.dim_item(self.stg_production, self.inputs.commodity_seed)

    @stored
    def dim_element(self) -> DataFrame:
        return dims.dim_element(self.spark)

    @stored
    def dim_year(self) -> DataFrame:
        return dims.dim_year(self.spark, self.cfg)

    # facts
    @stored
    def fct_production(self) -> DataFrame:
        return facts.fact_production(self.int_production, self.dim_area, self.dim_item,
                                     self.dim_year)

    @stored
    def fct_trade(self) -> DataFrame:
        return facts.fact_trade(self.int_trade, self.dim_area, self.dim_item, self.dim_year)

    @stored
    def fct_food_security(self) -> DataFrame:
        return facts.fact_food_security(self.int_food_security, self.dim_area, self.dim_year)

    # reports
    @stored
    def rpt_country_production_ranking(self) -> DataFrame:
        return reports.country_production_ranking(self.fct_production, self.dim_area,
                                                  self.dim_item, self.dim_year)

    @stored
    def rpt_global_production_trends(self) -> DataFrame:
        return reports.global_production_trends(self.fct_production, self.dim_item,
                                                self.dim_year, self.cfg)

    @stored
    def rpt_trade_balance(self) -> DataFrame:
        return reports.trade_balance(self.fct_trade, self.dim_area, self.dim_item, self.dim_year)

    @stored
    def rpt_food_security_dashboard(self) -> DataFrame:
        return reports.food_security_dashboard(self.fct_food_security, self.dim_area,
                                               self.dim_year)


def driver_models(spark: SparkSession, sf_dir: str, cfg: Config = DEFAULT,
                  materialize_raw: bool = True) -> Models:
    """One `Models` per (application, version of the source files): its DataFrames are
    lazy and immutable, so every query of the session shares them until a file changes."""
    base = checkpoint_dir(spark) if materialize_raw else None
    key = (spark.sparkContext.applicationId, sf_dir, driver_tables.version(spark, sf_dir), cfg, materialize_raw, base)
    if key not in _MODELS:
        store = f"{base.rstrip('/')}/cropflow-tables/{uuid.uuid4().hex}" if base else None
        _MODELS[key] = Models(spark, driver_inputs(spark, sf_dir, materialize_raw), cfg,
                              store_dir=store)
    return _MODELS[key]


# Stored layers in build order; each is written, then read back for its consumers.
STORED_LAYERS = [
    ["dim_area", "dim_item", "dim_element", "dim_year"],
    ["fct_production", "fct_trade", "fct_food_security"],
    ["rpt_country_production_ranking", "rpt_global_production_trends",
     "rpt_trade_balance", "rpt_food_security_dashboard"],
]


# Facts partitioned by year: year-range readers (A19) prune whole directories.
FACT_YEAR_PARTITIONS = {"fct_production": ["year"], "fct_trade": ["year"],
                        "fct_food_security": ["year"]}


def materialize(models: Models, warehouse_dir: str, layers=STORED_LAYERS,
                partition_by: dict[str, list[str]] | None = None) -> Models:
    """Write every stored model as Parquet (full replace) and return a `Models`
    whose nodes read the written tables. `warehouse_dir` must be a shared
    location (e.g. the cluster's warehouse or checkpoint folder).

    `partition_by` (e.g. `FACT_YEAR_PARTITIONS`) writes the named tables in
    Hive-style directories. Such a table is first rebalanced on its
    partition columns (REBALANCE hint): rows of one directory meet in few
    tasks instead of every task writing a file per directory, and AQE splits
    a hot directory (one year holding a third of the rows) across several
    tasks and files. It is read back with its own schema, so column types
    and order stay the same while filters on those columns prune directories."""
    spark = models.spark
    done: dict[str, DataFrame] = {}
    current = models
    for layer in layers:
        for name in layer:
            path = f"{warehouse_dir.rstrip('/')}/{name}"
            df = getattr(current, name)
            keys = (partition_by or {}).get(name)
            w = (df.hint("rebalance", *keys).write.partitionBy(*keys) if keys else df.write)
            w.mode("overwrite").option("compression", "snappy").parquet(path)
            back = spark.read.schema(df.schema).parquet(path) if keys else spark.read.parquet(path)
            done[name] = back.select(*df.columns)
        current = Models(spark, models.inputs, models.cfg, overrides=done)
    return current
