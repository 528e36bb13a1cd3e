"""Helpers shared by the operators: shared storage, distributed ranks, id filters."""

from __future__ import annotations

import contextlib
import functools
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir``.

    Only where the session names none (local tests) a temporary folder of this
    machine is made and set.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base and not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir names no folder that all executors share")
    if not base:
        base = "file://" + tempfile.mkdtemp(prefix="webloom-shared-")
        spark.conf.set("spark.checkpoint.dir", base)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(base)
    return base.rstrip("/")


def delete_at_exit(spark: SparkSession, path: str) -> None:
    """Have the driver's JVM delete ``path`` when it ends."""
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(at)


def scratch_path(spark: SparkSession, tag: str) -> str:
    """A fresh path under the shared folder, removed when the application ends."""
    path = f"{shared_dir(spark)}/webloom-{tag}-{uuid.uuid4().hex}"
    delete_at_exit(spark, path)
    return path


def written(df: DataFrame, tag: str) -> DataFrame:
    """Write ``df`` as Parquet into the shared folder and read it back.

    This cuts the lineage: what follows survives the loss of executors without
    computing ``df`` again.
    """
    spark = df.sparkSession
    path = scratch_path(spark, tag)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def written_counted(df: DataFrame, tag: str) -> tuple[DataFrame, int]:
    """As :func:`written`, and the number of rows, which is counted as they are written."""
    seen = Observation()
    out = written(df.observe(seen, F.count(F.lit(1)).alias("n")), tag)
    return out, int(seen.get["n"])


def checkpointed(df: DataFrame) -> DataFrame:
    """``df.checkpoint()`` into the shared folder; for small tables of an iteration."""
    shared_dir(df.sparkSession)
    return df.checkpoint()


def hash_bucket(col: Column | str, n: int, seed: int = 0) -> Column:
    """A bucket from 0 to ``n - 1``, the same for equal values (nulls included)."""
    return F.pmod(F.xxhash64(col, F.lit(seed)), F.lit(n)).cast("int")


def with_rank(df: DataFrame, groups: list[str], bucket: str, order: list[Column | str], name: str, small: bool) -> DataFrame:
    """Add the gapless rank from 0 of each row in its group, for groups of any size.

    Rows are ordered by the integer column ``bucket`` and then by ``order``.  The
    counts by (group, bucket) are summed up first and each bucket is ranked on
    its own, so no task holds more than a bucket of a group.  ``small`` says
    that groups times buckets has a fixed bound; the offsets are broadcast then
    and joined by key otherwise.
    """
    counts = df.groupBy(*groups, bucket).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*groups).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    if not groups:
        before = Window.partitionBy(F.lit(0)).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(*groups, bucket, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    joined = df.join(F.broadcast(offsets) if small else offsets, [*groups, bucket])
    inside = Window.partitionBy(*groups, bucket).orderBy(*order)
    return joined.withColumn(name, (F.col("_before") + F.row_number().over(inside) - 1).cast("long")).drop("_before")


#: Ids of dropped rows up to this count are broadcast (8 MB of longs); beyond it they are joined by key.
BROADCAST_IDS = 1_000_000


def without_ids(docs: DataFrame, dropped: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Rows of ``docs`` whose id is not in ``dropped``; ids that are null stay."""
    ids = dropped.select(id_col).distinct()
    if ids.limit(BROADCAST_IDS + 1).count() <= BROADCAST_IDS:
        ids = F.broadcast(ids)
    return docs.join(ids, id_col, "left_anti")


def names_rows(rows: DataFrame, id_col: str) -> bool:
    """Whether every id is there and on one row alone."""
    return rows.groupBy(id_col).count().filter(F.col(id_col).isNull() | (F.col("count") > 1)).isEmpty()


def only_rows(docs: DataFrame, kept: DataFrame, keys: list[str]) -> DataFrame:
    """One row of ``docs`` for each row of ``kept`` with the same keys; null equals null."""
    names = {k: lacking(docs.columns, "kept", k) for k in keys}
    wanted = kept.select(*[F.col(k).alias(names[k]) for k in keys])
    same = [F.col(k).eqNullSafe(F.col(names[k])) for k in keys]
    return docs.join(wanted, same, "left_semi").dropDuplicates(keys)


#: Called to free what a worker process keeps between tasks.
WORKER_CACHES: list = []


def clear_worker_caches() -> None:
    """Free what earlier operators keep in this worker process; memory-hungry ones call it first."""
    for clear in WORKER_CACHES:
        clear()
    trim_memory()


def trim_memory() -> None:
    """Give memory that is free in this process back to the system."""
    import ctypes
    import sys

    pa.default_memory_pool().release_unused()
    if sys.platform == "linux":
        ctypes.CDLL(None).malloc_trim(0)


def lean(run: Callable) -> Callable:
    """The Arrow function ``run``, but its worker process gives free memory back when a task begins and ends."""

    @functools.wraps(run)
    def trimmed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trim_memory()
        try:
            yield from run(batches)
        finally:
            trim_memory()

    return trimmed


@contextlib.contextmanager
def arrow_rows(spark: SparkSession, n: int) -> Iterator[None]:
    """While it lasts, Arrow batches have at most ``n`` rows; for rows of many kilobytes."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(n))
    try:
        yield
    finally:
        spark.conf.set(key, before)


#: Rows of an Arrow batch at most, where whole rows go to a Python worker in a plan that the caller runs.
BATCH_ROWS = 1000


def small_batches(spark: SparkSession, n: int = BATCH_ROWS) -> None:
    """From now on, Arrow batches of this session have at most ``n`` rows; fewer stay fewer.

    A plan takes the number when it runs, so an operator that only returns a plan can't
    put the number back as :func:`arrow_rows` does.  Batches are held whole by the executor,
    in Arrow's own memory, and by the worker; results don't depend on their size.
    """
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= n:
        spark.conf.set(key, str(n))


def string_buffers(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and row offsets of an Arrow string column, without copying; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks() if column.num_chunks != 1 else column.chunk(0)
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    n = len(column)
    _, at, data = column.buffers()
    if n == 0 or at is None:
        return np.empty(0, np.uint8), np.zeros(n + 1, np.int64)
    offsets = np.frombuffer(at, np.int64 if wide else np.int32)[column.offset : column.offset + n + 1].astype(np.int64)
    data = np.empty(0, np.uint8) if data is None else np.frombuffer(data, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


#: Bytes of texts that are worked on at once; arrays of numbers for each byte take many times as much.
SLICE_BYTES = 1 << 19


def row_slices(offsets: np.ndarray, most: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``most`` bytes each; a longer row is alone."""
    n, i = len(offsets) - 1, 0
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + most, "right")) - 1)
        yield i, min(j, n)
        i = min(j, n)


def crc_bucket(id_col: str, n: int) -> Column:
    """crc32 of the id written as text, modulo ``n``."""
    return F.pmod(F.crc32(F.col(id_col).cast("string")), F.lit(n))


def lacking(columns: list[str], *wanted: str) -> str:
    """A column name that clashes with none of ``columns``, starting with an underscore."""
    name = "_" + "_".join(wanted)
    while name in columns:
        name = "_" + name
    return name
