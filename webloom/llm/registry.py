"""The ``opN_<name>`` queries over the driver's tables, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from webloom.llm import decontaminate, exact_dedup, langid, ngram_join, packing, quality, sharding, token_counts, toxicity, warc

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of equal texts of all documents; see ``exact_dedup`` for nulls, repeats and empty tables."""
    return exact_dedup.exact_dedup(table(spark, sf_dir, "documents"))


def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in eight shards under law ``rows``; see ``shard_documents`` for nulls, repeats and empty tables."""
    return sharding.shard_documents(table(spark, sf_dir, "documents"))


def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark windows in all documents; see ``contamination`` for nulls, repeats and empty tables."""
    return decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("items")


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity scores of all documents; see ``toxicity.toxicity`` for nulls, labels and empty tables."""
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of similar documents; see ``ngram_components`` for nulls, repeats and empty tables."""
    return ngram_join.ngram_components(table(spark, sf_dir, "documents"))


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Languages of all documents; see ``language_id`` for nulls, repeats and empty tables."""
    return langid.language_id(table(spark, sf_dir, "documents"))


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in sequences of 4096 tokens; see ``pack_documents`` for nulls, repeats and empty tables."""
    return packing.pack_documents(table(spark, sf_dir, "documents"))


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality scores of all documents; see ``quality_classifier`` for nulls, labels and empty tables."""
    return quality.quality_classifier(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


#: Context limits that :func:`op9_token_counts` answers besides the lengths that occur.
USUAL_LIMITS = [128 << k for k in range(11)]


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Length histogram and its suffix sums; see ``length_histogram`` for nulls, empty texts and an empty table."""
    return token_counts.length_histogram(table(spark, sf_dir, "documents"), limits=USUAL_LIMITS)


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """WARC records of all pages, read back through the index; see ``archive_pages`` for nulls, repeats and empty tables."""
    return warc.archive_pages(table(spark, sf_dir, "pages"))


def queries() -> dict[str, Query]:
    return {f.__name__: f for f in (op1_exact_dedup, op2_sharding, op3_decontaminate, op4_toxicity, op5_ngram_join, op6_language_id, op7_packing, op8_quality, op9_token_counts, op10_warc)}


def oracle_sql() -> dict[str, str]:
    return {"op1_exact_dedup": exact_dedup.ORACLE, "op3_decontaminate": decontaminate.ORACLE, "op5_ngram_join": ngram_join.ORACLE, "op10_warc": warc.ORACLE}
