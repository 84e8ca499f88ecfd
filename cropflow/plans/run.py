"""Run the whole pipeline: validate, load, build every model, test.

    python -m cropflow.plans.run --sf-dir /root/testdata/sf0.1 --warehouse /shared/warehouse

The counterpart of the reference's sequence (validate the inputs, load the
raw layer, build the models, run the data tests). Every table and report is
written under `--warehouse` (a shared folder on a cluster); the run prints
one JSON summary line. Only small summaries reach the driver.
"""

from __future__ import annotations

import argparse
import json
import time

from pyspark.sql import SparkSession

from ..operators import checks
from ..sources import csv_ingest, driver_tables, ledger
from . import dq_suite
from .pipeline import FACT_YEAR_PARTITIONS, Models, driver_inputs, materialize, stored_raw


def run(spark: SparkSession, sf_dir: str, warehouse: str, partition_facts: bool = False) -> dict:
    wh = warehouse.rstrip("/")
    t0 = time.time()
    inputs = driver_inputs(spark, sf_dir)
    raw = inputs.raw
    tables = {"production": raw.production, "trade": raw.trade, "fbs": raw.fbs}

    # validation suite (B) and load reconciliation
    suite = checks.validation_suite(tables)
    csv_ingest.write_table(suite, f"{wh}/validation_checks")
    summary = {r.dataset: r.asDict() for r in checks.validation_summary(
        spark.read.parquet(f"{wh}/validation_checks")).collect()}
    rec = None
    raw = stored_raw(spark, sf_dir, raw)
    loads = {r["source"]: r["rows"] for r in ledger.last_loads(spark, raw.ledger).collect()}
    for name in tables:
        part = csv_ingest.reconcile(loads[name], getattr(raw, name), name)
        rec = part if rec is None else rec.unionByName(part)
    csv_ingest.write_report(rec, f"{wh}/row_count_reconciliation")

    # models: dims, facts, reports as tables
    stored = materialize(Models(spark, inputs), wh,
                         partition_by=FACT_YEAR_PARTITIONS if partition_facts else None)

    # data tests (DQ): generic summaries and singular failing rows
    tests = (dq_suite.not_null_tests(stored).unionByName(dq_suite.unique_tests(stored))
             .unionByName(dq_suite.accepted_values_tests(stored))
             .unionByName(dq_suite.relationship_tests(stored)))
    csv_ingest.write_table(tests, f"{wh}/data_tests")
    failing = [r.asDict() for r in spark.read.parquet(f"{wh}/data_tests")
               .where("failures > 0").collect()]
    return {"sf_dir": sf_dir, "warehouse": wh, "seconds": round(time.time() - t0, 2),
            "validation": summary, "failing_data_tests": failing}


def main() -> None:
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf-dir", required=True)
    ap.add_argument("--warehouse", required=True)
    ap.add_argument("--master", default=None)
    ap.add_argument("--partition-facts", action="store_true",
                    help="write the fact tables partitioned by year")
    a = ap.parse_args()
    if a.master:
        from ..session import local_session
        spark = local_session(a.master.removeprefix("local[").removesuffix("]"))
    else:
        spark = SparkSession.builder.getOrCreate()
    print(json.dumps(run(spark, a.sf_dir, a.warehouse, a.partition_facts), default=str))


if __name__ == "__main__":
    main()
