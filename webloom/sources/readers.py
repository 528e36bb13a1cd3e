"""Readers of the engine's files and of seed lists."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from webloom.operators.validate import valid_pages
from webloom.schemas import PAGE, RANK, STATE


def _exists(spark: SparkSession, path: str) -> bool:
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return bool(at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(at))


def _text(spark: SparkSession, path: str, **options) -> DataFrame:
    """Text of a file; nothing if it isn't there."""
    return spark.read.text(path, **options) if _exists(spark, path) else spark.createDataFrame([], "value string")


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines of text files, unparsed (column ``value``)."""
    return spark.read.text(path)


def read_pages(spark: SparkSession, path: str, need_one: bool = False) -> DataFrame:
    """PAGE rows of JSON lines; lines that are no records are left out."""
    return valid_pages(read_lines(spark, path), need_one=need_one)


def known_urls(spark: SparkSession, path: str) -> DataFrame:
    return read_pages(spark, path).select("url").filter("url is not null").distinct()


def read_state(spark: SparkSession, path: str) -> DataFrame:
    """STATE rows of a JSON object url -> {hash, category, last_crawled}; a missing or corrupt file is empty."""
    try:
        text = spark.read.text(path, wholetext=True)
        entry = "map<string, struct<hash: string, category: string, last_crawled: string>>"
        rows = text.select(F.explode(F.map_entries(F.from_json("value", entry))).alias("e"))
        return rows.select(F.col("e.key").alias("url"), "e.value.hash", "e.value.category", F.try_to_timestamp(F.col("e.value.last_crawled")).alias("last_crawled"))
    except Exception as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return spark.createDataFrame([], STATE)


def read_pending(spark: SparkSession, path: str) -> DataFrame:
    """URLs of a JSON array, repeats included; what can't be read, and a file that isn't there, is empty."""
    return _text(spark, path, wholetext=True).select(F.explode(F.from_json("value", "array<string>")).alias("url"))


def consume(spark: SparkSession, path: str) -> None:
    """Delete a queue that has been read."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def read_blacklist(spark: SparkSession, path: str) -> DataFrame:
    """Distinct lines without the white space around them, blank ones left out; a missing file is empty."""
    return _text(spark, path).select(F.regexp_replace("value", r"^\s+|\s+$", "").alias("url")).filter("url <> ''").distinct()


def read_ranks(spark: SparkSession, path: str) -> DataFrame:
    """(id, rank) of tab-separated lines; lines without a number are left out, of repeats the last line of the last file counts.

    A missing file is empty.
    """
    if not _exists(spark, path):
        return spark.createDataFrame([], "id string, rank double")
    rows = spark.read.schema(RANK).option("sep", "\t").option("mode", "PERMISSIVE").csv(path)
    place = F.struct("_metadata.file_path", "_metadata.file_block_start", F.monotonically_increasing_id())
    return rows.select("url", "rank", place.alias("_at")).filter("rank is not null").groupBy(F.col("url").alias("id")).agg(F.max_by("rank", "_at").alias("rank"))


def read_markdown(spark: SparkSession, path: str) -> DataFrame:
    """(path, md) of Markdown files."""
    return spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("md"))


def read_legacy_dataset(spark: SparkSession, path: str) -> DataFrame:
    """url, text, title, category and timestamp of the older record forms."""
    kind = "url string, text string, meta struct<title: string, category: string, timestamp: string>"
    return spark.read.schema(kind).json(path).select("url", "text", "meta.title", "meta.category", "meta.timestamp")


def certificate_hosts(text: DataFrame, root: str, all_names: bool = False) -> DataFrame:
    """Hosts of a certificate log (column ``value``: a JSON array), the first name of each entry or all."""
    rows = text.select(F.explode(F.from_json("value", "array<struct<name_value: string>>")).alias("e")).select(F.col("e.name_value").alias("names"))
    names = rows.select(F.explode(F.split("names", "\n")).alias("host")) if all_names else rows.select(F.substring_index("names", "\n", 1).alias("host"))
    return names.select(F.replace("host", F.lit("*."), F.lit("")).alias("host")).filter(F.col("host").endswith(root)).distinct()


def archive_hosts(text: DataFrame, most: int = 5000) -> DataFrame:
    """Hosts of a web archive's listing: an array of arrays whose first row is a header."""
    rows = F.from_json("value", "array<array<string>>")
    urls = text.select(F.explode(F.slice(rows, 2, most)).alias("r")).select(F.col("r")[0].alias("u"))
    return urls.select(F.try_parse_url("u", F.lit("AUTHORITY")).alias("host")).filter("host is not null").distinct()


def search_hosts(lines: DataFrame, root: str) -> DataFrame:
    """Hosts of ``host,address`` lines; a body with ``error`` in it has none."""
    bad = lines.filter(F.lower("value").contains("error")).limit(1).select(F.lit(True).alias("_bad"))
    hosts = lines.select(F.lower(F.trim(F.substring_index("value", ",", 1))).alias("host")).filter(F.col("host").endswith(root) & (F.col("host") != ""))
    return hosts.join(F.broadcast(bad), F.lit(True), "left_anti").distinct()


def history_hosts(text: DataFrame, root: str) -> DataFrame:
    """Hosts of a DNS history: prefixes under ``subdomains``."""
    return text.select(F.explode(F.from_json("value", "subdomains array<string>")["subdomains"]).alias("p")).select(F.concat("p", F.lit("." + root)).alias("host")).distinct()


def read_page_table(spark: SparkSession, path: str) -> DataFrame:
    """PAGE rows of Parquet."""
    return spark.read.schema(PAGE).parquet(path)
