"""Incremental form of the CSV ingest (Structured Streaming).

The reference reloads whole yearly files. On a cluster the same load runs as
a file stream: each new CSV landing in a folder is read with the declared
text schema, cleaned by the same expressions as the batch ingest
(`csv_ingest.prepare`), stamped with its own file name and load instant, and
appended to the Parquet raw table. The file sink and the checkpoint give
exactly-once output across restarts and lost executors; the checkpoint lives
in the shared folder named by `spark.checkpoint.dir`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..sources.csv_ingest import clean_column_name, typed_columns

# The column headers of the downloaded CSV files.
CSV_COLUMNS = ["Area Code", "Area Code (M49)", "Area", "Item Code", "Item Code (CPC)", "Item",
               "Element Code", "Element", "Year Code", "Year", "Unit", "Value", "Flag", "Note"]


def text_schema(columns: list[str] = CSV_COLUMNS) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType()) for c in columns])


def cleaned_stream(spark: SparkSession, landing_dir: str,
                   columns: list[str] = CSV_COLUMNS, strip_commas: bool = False,
                   multi_line: bool = False) -> DataFrame:
    raw = (spark.readStream.schema(text_schema(columns)).option("header", True)
           .option("escape", '"').option("multiLine", multi_line).csv(landing_dir))
    names = [clean_column_name(c) for c in columns]
    named = raw.select(*[F.col(f"`{c}`").alias(n) for c, n in zip(columns, names)],
                       F.col("_metadata.file_name").alias("_source_file"))
    return named.select(*typed_columns(names, strip_commas), F.current_timestamp().alias("_loaded_at"),
                        "_source_file")


def start_ingest(spark: SparkSession, landing_dir: str, table_dir: str, name: str,
                 checkpoint_root: str | None = None, available_now: bool = True,
                 strip_commas: bool = False) -> StreamingQuery:
    """Append newly landed CSV files to the Parquet raw table at `table_dir`."""
    root = checkpoint_root or spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        raise ValueError("no shared checkpoint folder: set spark.checkpoint.dir")
    w = (cleaned_stream(spark, landing_dir, strip_commas=strip_commas).writeStream.format("parquet")
         .option("path", table_dir)
         .option("checkpointLocation", f"{root.rstrip('/')}/cropflow-ingest/{name}")
         .outputMode("append"))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()
