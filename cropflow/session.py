"""Session construction for tests, the bench and local runs."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

LOCAL_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  driver_memory: str = "8g", extra: dict | None = None) -> SparkSession:
    b = (SparkSession.builder.master(f"local[{cores}]").appName("cropflow")
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
         .config("spark.driver.memory", driver_memory))
    for k, v in {**LOCAL_CONF, **(extra or {})}.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


#: Scratch folders of local runs, by application (the setting itself cannot change in a running session).
_SCRATCH: dict[str, str] = {}


def checkpoint_dir(spark: SparkSession, local_fallback: bool = False) -> str | None:
    """The shared folder named by `spark.checkpoint.dir`.

    On a cluster this must be set by the deployment. Only local runs (tests,
    bench) may pass ``local_fallback=True`` to get a fresh scratch folder.
    """
    d = spark.conf.get("spark.checkpoint.dir", None) or _SCRATCH.get(spark.sparkContext.applicationId)
    if not d and local_fallback:
        d = _SCRATCH[spark.sparkContext.applicationId] = tempfile.mkdtemp(prefix="cropflow-ckpt-")
        spark.sparkContext.setCheckpointDir(d)
    return d


def shared_path(spark: SparkSession, kind: str) -> str:
    """A fresh folder under the shared folder named by `spark.checkpoint.dir`."""
    # a local run (tests) may have none set and gets a scratch folder; a cluster must name one
    base = checkpoint_dir(spark, local_fallback=spark.sparkContext.master.split("[")[0] == "local")
    if not base:
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return f"{base.rstrip('/')}/{kind}/{uuid.uuid4().hex}"


def written(df: DataFrame, kind: str) -> DataFrame:
    """`df` written once as Parquet in the shared folder and read back: computed once for
    several consumers, lineage cut, safe when an executor is lost."""
    path = shared_path(df.sparkSession, f"cropflow-{kind}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
