"""Intermediate tables in the shared folder the cluster names in ``spark.checkpoint.dir``.

A written table cuts lineage and survives the loss of an executor: every
operator that needs an intermediate result twice, or that iterates, writes it
here and reads it back.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


#: Scratch folders of local runs, by application.
_scratch: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """The session's shared folder; a scratch folder only where none is set (tests, local runs)."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or _scratch.get(spark.sparkContext.applicationId)
    if not folder:
        if spark.sparkContext.master.split("[")[0] != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = _scratch[spark.sparkContext.applicationId] = tempfile.mkdtemp(prefix="cropflow-llm-")
    return folder


_made: list[str] = []


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as Parquet in the shared folder and read back."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/cropflow-llm/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    _made.append(path)
    return spark.read.schema(df.schema).parquet(path)


def free_shuffles(spark: SparkSession) -> None:
    """Lets Spark's cleaner delete the shuffle files of finished jobs, which otherwise stay on
    disk until the driver happens to collect its garbage; call it after a table is written."""
    spark.range(1).count()  # Spark holds on to a job for a while, or until the next one runs
    spark.sparkContext._jvm.System.gc()


def release(spark: SparkSession) -> int:
    """Deletes the tables this application has written so far; call it once the results
    that read them have been consumed. Returns their number."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for path in _made:
        p = jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(conf).delete(p, True)
    n = len(_made)
    _made.clear()
    return n
