"""Tables of an iteration, written to the shared folder so that lineage stays short."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame


def saved(df: DataFrame, tag: str) -> DataFrame:
    """Write ``df`` under ``spark.checkpoint.dir`` and read it back; the files go when the application ends.

    Only where the session names no such folder, as in local runs, a temporary one is set.
    """
    spark = df.sparkSession
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base and not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir names no folder that all executors share")
    if not base:
        base = "file://" + tempfile.mkdtemp(prefix="webloom-tables-")
        spark.conf.set("spark.checkpoint.dir", base)
    path = f"{base.rstrip('/')}/webloom-{tag}-{uuid.uuid4().hex}"
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(at)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
