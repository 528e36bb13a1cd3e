"""The crawl loop as a stream: batches of page records keep a state of changes.

Files of JSON lines are the source; each batch is validated, classified, compared
with the state by content hash and merged into the page and state snapshots.  A
batch that is run again after a failure gives the same tables.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from webloom.operators.classify import CATEGORIES, Taxonomy, classify
from webloom.operators.state import change_status, latest, state_rows, upsert, with_hash
from webloom.operators.validate import valid_pages
from webloom.schemas import PAGE, STATE
from webloom.sources.sinks import has_snapshot, read_snapshot, write_snapshot


def _current(spark: SparkSession, base: str, schema) -> DataFrame:
    return read_snapshot(spark, base) if has_snapshot(spark, base) else spark.createDataFrame([], schema)


def merge_batch(lines: DataFrame, base: str, as_of: dt.datetime, rules: Taxonomy = CATEGORIES) -> DataFrame:
    """Merge one batch of lines into ``base/pages`` and ``base/state``; returns how many of its pages have which status."""
    spark = lines.sparkSession
    pages = latest(valid_pages(lines).filter("url <> ''"), "url", "timestamp")
    text = F.concat_ws(" ", "title", "content")
    pages = classify(pages.drop("category"), F.col("url"), text, rules).drop("score")
    state = _current(spark, f"{base}/state", STATE)
    changed = change_status(with_hash(pages, F.col("content")), state).persist()
    try:
        kept = changed.filter("status <> 'UNCHANGED'").select(*[f.name for f in PAGE])
        old_pages = _current(spark, f"{base}/pages", PAGE)
        write_snapshot(upsert(old_pages, kept, "url"), f"{base}/pages")
        write_snapshot(upsert(state, state_rows(changed, as_of), "url"), f"{base}/state")
        return spark.createDataFrame(changed.groupBy("status").count().toArrow())  # three rows at most
    finally:
        changed.unpersist()


def run_stream(spark: SparkSession, source: str, base: str, as_of: dt.datetime, rules: Taxonomy = CATEGORIES) -> None:
    """Take in all files of ``source`` that are new since the last run."""

    def each(batch: DataFrame, _: int) -> None:
        merge_batch(batch, base, as_of, rules)

    lines = spark.readStream.schema("value string").text(source)
    query = lines.writeStream.foreachBatch(each).option("checkpointLocation", f"{base}/checkpoint").trigger(availableNow=True).start()
    query.awaitTermination()
