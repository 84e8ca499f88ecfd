"""Per-file digest for B11, streamed in fixed-size chunks inside the task.

`binaryFile`'s `content` column holds a whole file in one row (at most 2 GB,
all of it in task memory). A file's MD5 is sequential by nature, so one task
per file is the unit of work; this helper keeps that task at constant memory
by reading through the path's filesystem (local, HDFS or object store, via
pyarrow) in 8 MB chunks. It runs on one row per file, never per data row.
"""

from __future__ import annotations

import hashlib

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

CHUNK_BYTES = 8 * 1024 * 1024


def md5_of(path: str, chunk: int = CHUNK_BYTES) -> str:
    from pyarrow import fs
    filesystem, p = fs.FileSystem.from_uri(path)
    h = hashlib.md5()
    with filesystem.open_input_stream(p) as f:
        while True:
            block = f.read(chunk)
            if not block:
                break
            h.update(block)
    return h.hexdigest()


@F.pandas_udf(T.StringType())
def file_md5(paths: pd.Series) -> pd.Series:
    return pd.Series([None if p is None else md5_of(p) for p in paths], dtype=object)
