"""Writers: snapshots with a pointer, text forms and Markdown trees."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from webloom.operators.graph import rank_lines
from webloom.operators.index import index_lines


def _path(spark: SparkSession, path: str):
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at, at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def write_snapshot(df: DataFrame, base: str) -> str:
    """Write a new version of a table and make it current by renaming it to the next number; returns its path.

    Nothing is deleted or replaced: readers of the version before are not disturbed, and
    whatever fails, the last version that was renamed stays current.  Of two writers
    that take the same number one fails.
    """
    spark = df.sparkSession
    numbers = _versions(spark, base)
    draft, version = f"{base}/draft-{uuid.uuid4().hex}", f"{base}/v-{(numbers[-1] if numbers else 0) + 1:012d}"
    df.write.parquet(draft)
    (new, fs), (current, _) = _path(spark, draft), _path(spark, version)
    if fs.exists(current) or not fs.rename(new, current):
        raise OSError(f"{version} could not be made current")
    return version


def _versions(spark: SparkSession, base: str) -> list[int]:
    """Numbers of the versions of a table, ascending."""
    at, fs = _path(spark, base)
    names = [str(f.getPath().getName()) for f in fs.listStatus(at)] if fs.exists(at) else []
    return sorted(int(n[2:]) for n in names if n.startswith("v-"))


def has_snapshot(spark: SparkSession, base: str) -> bool:
    return bool(_versions(spark, base))


def read_snapshot(spark: SparkSession, base: str) -> DataFrame:
    """The current version of a table: the one with the highest number."""
    numbers = _versions(spark, base)
    if not numbers:
        raise FileNotFoundError(f"{base} has no version")
    return spark.read.parquet(f"{base}/v-{numbers[-1]:012d}")


def drop_snapshots(spark: SparkSession, *bases: str) -> None:
    """Start afresh: delete tables with all their versions."""
    for base in bases:
        at, fs = _path(spark, base)
        fs.delete(at, True)


def write_pages(pages: DataFrame, path: str, mode: str = "overwrite") -> None:
    """PAGE rows as JSON lines, with null fields written."""
    pages.select(F.to_json(F.struct(*pages.columns), {"ignoreNullFields": "false"}).alias("value")).write.mode(mode).text(path)


def write_urls(urls: DataFrame, path: str) -> None:
    """Sorted lines of distinct URLs, one file."""
    urls.select("url").distinct().orderBy("url").coalesce(1).write.mode("overwrite").text(path)


def write_pending(urls: DataFrame, path: str) -> None:
    """URLs (pos, url) as one JSON array in the order of ``pos``, repeats included: what ``read_pending`` reads.

    The queue of one run is one value, as the format asks; it is built in one task.
    """
    line = urls.groupBy().agg(F.array_sort(F.collect_list(F.struct("pos", "url"))).alias("q")).select(F.to_json(F.transform("q", lambda x: x["url"])).alias("value"))
    line.coalesce(1).write.mode("overwrite").text(path)


def append_urls(urls: DataFrame, path: str) -> None:
    """Add lines to a list of URLs; those that it has already stay as they are."""
    urls.select("url").write.mode("append").text(path)


def delete_files(gone: DataFrame, path: str) -> None:
    """Delete the files ``path/category/filename`` of the rows (category, filename); missing ones are passed over."""

    def run(rows):
        import pyarrow.fs as pafs

        fs, root = pafs.FileSystem.from_uri(path if "://" in path or path.startswith("file:") else f"file://{path}")
        for r in rows:
            name = f"{root}/{r['category']}/{r['filename']}"
            if fs.get_file_info(name).type == pafs.FileType.File:
                fs.delete_file(name)

    gone.select("category", "filename").distinct().foreachPartition(run)


def write_ranks(ranks: DataFrame, path: str) -> None:
    rank_lines(ranks).write.mode("overwrite").text(path)


def write_pairs(pairs: DataFrame, path: str) -> None:
    """Lines ``dist=d TAB a TAB b``."""
    pairs.select(F.concat_ws("\t", F.concat(F.lit("dist="), F.col("dist").cast("string")), F.col("a").cast("string"), F.col("b").cast("string")).alias("value")).write.mode("overwrite").text(path)


def write_index(index: DataFrame, path: str) -> None:
    index_lines(index).write.mode("overwrite").text(path)


def write_markdown(rendered: DataFrame, path: str) -> None:
    """(category, filename, md) as Parquet by category; only categories that occur are overwritten."""
    rendered.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("category").parquet(path)


def write_markdown_files(rendered: DataFrame, path: str) -> None:
    """One file for each page under ``path/category/filename``, by any file system that a URI names."""

    def run(rows):
        import pyarrow.fs as pafs

        fs, root = pafs.FileSystem.from_uri(path if "://" in path or path.startswith("file:") else f"file://{path}")
        for r in rows:
            fs.create_dir(f"{root}/{r['category']}", recursive=True)
            with fs.open_output_stream(f"{root}/{r['category']}/{r['filename']}", compression=None) as out:
                out.write(r["md"].encode())

    rendered.foreachPartition(run)
