"""Atomic replace of a stored table, whole or by partition value.

Rows go to `<table>/<key>=<value>/cropflow_write=<write>/` directories and are never
rewritten. A commit is one small JSON file, `_commits/<number>.json`, that names
the current write of every key value; it is created under its final name by a
rename that fails if the number is taken, so a commit happens whole or not at
all and of two writers one must start again. A reader takes the newest commit
and reads the table with filters on the key and the write, which prune to the
current directories; it keeps its version while others commit, because files
stay until `vacuum` removes what no kept commit names.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Partition column of a write; a table cannot have a column of this name.
WRITE = "cropflow_write"


class Conflict(RuntimeError):
    """Another writer committed first."""


def _path(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def commits(spark: SparkSession, table: str) -> list[int]:
    p, fs = _path(spark, f"{table}/_commits")
    if not fs.exists(p):
        return []
    return sorted(int(s.getPath().getName()[:-5]) for s in fs.listStatus(p) if s.getPath().getName()[0].isdigit())


def _commit(spark: SparkSession, table: str, number: int, content: dict) -> None:
    hidden, fs = _path(spark, f"{table}/_commits/.{uuid.uuid4().hex}")
    final, _ = _path(spark, f"{table}/_commits/{number}.json")
    fs.mkdirs(final.getParent())
    out = fs.create(hidden, True)
    out.write(bytearray(json.dumps(content).encode()))
    out.close()
    if fs.exists(final) or not fs.rename(hidden, final):
        fs.delete(hidden, False)
        raise Conflict(f"commit {number} of {table} is taken")


def state(spark: SparkSession, table: str, number: int | None = None) -> tuple[int, dict]:
    """Number and content of a commit (the newest by default)."""
    known = commits(spark, table)
    if not known:
        raise FileNotFoundError(f"{table} has no commit")
    number = known[-1] if number is None else number
    text = spark.read.option("wholetext", True).text(f"{table}/_commits/{number}.json").first()[0]
    return number, json.loads(text)


def publish(df: DataFrame, table: str, key: str, replaced: list | None = None) -> int:
    """Makes `df` the rows of its values of `key`, and commits.

    With `replaced` (values) only these change; rows of other values are refused. Without it the
    whole table is replaced. Returns the commit's number.
    """
    spark, known = df.sparkSession, commits(df.sparkSession, table)
    base = known[-1] if known else 0
    content = state(spark, table, base)[1] if known else {"key": key, "schema": json.loads(df.schema.json()), "writes": {}}
    if WRITE in df.columns or content["key"] != key or T.StructType.fromJson(content["schema"]).simpleString() != df.schema.simpleString():
        raise ValueError("key and schema must be those of the table")
    write = uuid.uuid4().hex
    rows = df.hint("rebalance", key).withColumn(WRITE, F.lit(write))
    rows.write.mode("append").partitionBy(key, WRITE).option("compression", "snappy").parquet(table)
    # one value per partition directory
    values = [r[0] for r in spark.read.schema(_stored(df.schema)).parquet(table).where(F.col(WRITE) == write).select(key).distinct().collect()]
    if replaced is not None and set(values) - set(replaced):
        raise ValueError(f"rows of other values than those replaced: {sorted(set(values) - set(replaced), key=str)}")
    kept = {} if replaced is None else {w: [v for v in held if v not in replaced] for w, held in content["writes"].items()}
    writes = {w: held for w, held in {**kept, write: values}.items() if held}
    _commit(spark, table, base + 1, {**content, "writes": writes})
    return base + 1


def _stored(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField(WRITE, T.StringType())])


def current(spark: SparkSession, table: str, number: int | None = None) -> DataFrame:
    """The table as of a commit (the newest by default); other commits do not change what it reads."""
    _, content = state(spark, table, number)
    schema, key = T.StructType.fromJson(content["schema"]), content["key"]
    held = F.lit(False)
    for write, values in content["writes"].items():
        some = [v for v in values if v is not None]
        mine = F.col(key).isin(*some) if some else F.lit(False)
        held = held | ((F.col(WRITE) == write) & ((mine | F.col(key).isNull()) if None in values else mine))
    return spark.read.schema(_stored(schema)).parquet(table).where(held).select(*schema.fieldNames())


def vacuum(spark: SparkSession, table: str, keep: int = 1) -> int:
    """Removes the directories that none of the last `keep` commits names, and older commits; returns their number."""
    known = commits(spark, table)
    alive = {(str(v), w) for n in known[-keep:] for w, values in state(spark, table, n)[1]["writes"].items() for v in values}
    removed = 0
    root, fs = _path(spark, table)
    for of_value in fs.listStatus(root):
        name = of_value.getPath().getName()
        if "=" not in name:
            continue
        value = name.split("=", 1)[1]
        for of_write in fs.listStatus(of_value.getPath()):
            write = of_write.getPath().getName().split("=", 1)[1]
            if ("None" if value == "__HIVE_DEFAULT_PARTITION__" else value, write) not in alive:
                fs.delete(of_write.getPath(), True)
                removed += 1
    for n in known[:-keep]:
        fs.delete(_path(spark, f"{table}/_commits/{n}.json")[0], False)
    return removed
