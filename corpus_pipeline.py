"""The training-data pipeline over ``documents``: filter, deduplicate, decontaminate, pack.

Each stage takes what its predecessor kept and returns the columns of ``documents``,
but the last, which returns the packed pieces.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from webloom.llm import decontaminate, exact_dedup, ngram_join, packing, quality
from webloom.llm.common import written


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier doesn't reject.

    Null and empty texts are scored as they are, ids are used to find labels alone, and
    repeated rows are each judged; without labels of both kinds all score the same.  An
    empty table stays empty; columns of any name go through.
    """
    return quality.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts, the one with the smallest id.

    Null texts and empty ones are equal; null and repeated ids do no harm, one row of each
    text stays.  An empty table stays empty; columns of any name go through.
    """
    return exact_dedup.drop_exact_copies(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of similar shingle sets, the one with the smallest id.

    Texts that are null or have no words all stay; null and repeated ids do no harm, one
    row of each component stays.  An empty table stays empty; columns of any name go through.
    """
    return ngram_join.keep_one_of_each(docs)


def benchmark_free(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no passage of the benchmark.

    Null and empty texts hold none; ids are not looked at.  An empty table stays empty, and
    an empty benchmark drops nothing; columns of any name go through.
    """
    return decontaminate.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of 4096 tokens.

    Null and empty texts are the end id alone; rows that repeat an id are separate
    documents, and a null id stays null.  An empty table gives no pieces.
    """
    return packing.pack_documents(docs)


STAGES = [
    ("quality_filter", quality_filter),
    ("exact_copies", exact_copies),
    ("near_copies", near_copies),
    ("benchmark_free", benchmark_free),
    ("packed", packed),
]

#: The quality classifier and the tokenizer can't be written in SQL; tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply :data:`STAGES` to ``documents``; what each keeps is written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
