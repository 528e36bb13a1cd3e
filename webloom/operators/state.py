"""Keyed tables: change detection, upserts, deletes, freshness, pruning and recovery."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from webloom.functions.text import content_hash


def change_status(pages: DataFrame, state: DataFrame, hash_col: str = "hash") -> DataFrame:
    """Pages with ``status`` NEW, UPDATED or UNCHANGED by the hash in the state, and ``moved`` if the category differs."""
    known = state.select("url", F.col("hash").alias("_hash"), F.col("category").alias("_category"))
    status = F.when(F.col("_hash").isNull(), "NEW").when(F.col("_hash") != F.col(hash_col), "UPDATED").otherwise("UNCHANGED")
    moved = F.col("_category").isNotNull() & (F.col("_category") != F.col("category")) if "category" in pages.columns else F.lit(False)
    return pages.join(known, "url", "left").withColumn("status", status).withColumn("moved", moved).drop("_hash", "_category")


def with_hash(pages: DataFrame, content: Column) -> DataFrame:
    return pages.withColumn("hash", content_hash(F.coalesce(content, F.lit(""))))


def latest(rows: DataFrame, key: str, *order: Column | str) -> DataFrame:
    """The last row of each key in the given order."""
    newest = [F.desc(c) if isinstance(c, str) else c.desc() for c in order]
    return rows.withColumn("_nth", F.row_number().over(Window.partitionBy(key).orderBy(*newest))).filter("_nth = 1").drop("_nth")


def upsert(old: DataFrame, new: DataFrame, key: str, *order: Column | str) -> DataFrame:
    """``old`` with the rows of ``new`` in place of those with the same key; of several new ones the last counts.

    Without an order the largest row by its other columns, in their order, is the last.
    """
    fresh = latest(new, key, *(order or [c for c in new.columns if c != key]))
    return old.join(fresh.select(key), key, "left_anti").unionByName(fresh)


def delete(table: DataFrame, gone: DataFrame, key: str) -> DataFrame:
    return table.join(gone.select(key), key, "left_anti")


def state_rows(changed: DataFrame, as_of: dt.datetime, touch_unchanged: bool = False) -> DataFrame:
    """Rows of the state for NEW and UPDATED pages; unchanged ones keep their time unless ``touch_unchanged``."""
    kept = changed if touch_unchanged else changed.filter("status <> 'UNCHANGED'")
    return kept.select("url", "hash", "category", F.lit(as_of).alias("last_crawled"))


def parsed_time(text: Column) -> Column:
    """A time from ISO text: missing is the year 2000, unreadable is the epoch."""
    return F.when(text.isNull(), F.to_timestamp(F.lit("2000-01-01"))).otherwise(F.coalesce(F.try_to_timestamp(text), F.timestamp_seconds(F.lit(0))))


def is_fresh(crawled: Column, as_of: Column, days: int = 7) -> Column:
    """Known and younger than ``days`` days; exactly that old is stale."""
    return F.coalesce(as_of - crawled < F.make_dt_interval(F.lit(days)), F.lit(False))


def stale_suspects(state: DataFrame, visited: DataFrame, run_start: Column) -> DataFrame:
    """URLs of the state that this run has not visited."""
    seen = F.coalesce("visited_ts", F.timestamp_seconds(F.lit(0)))
    return state.join(visited.select("url", "visited_ts"), "url", "left").filter(seen < run_start).select("url")


def gone(recheck: DataFrame) -> DataFrame:
    """URLs whose recheck says that they are gone."""
    return recheck.filter(F.col("status").isin(404, 410)).select("url").distinct()


def recover(blacklist: DataFrame, recheck: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Blacklisted URLs that answer again, and the others."""
    good = recheck.filter("status = 200").select("url").distinct()
    return blacklist.join(good, "url", "left_semi").select("url").distinct(), blacklist.join(good, "url", "left_anti").select("url").distinct()


def restored_frontier(pending: DataFrame, visited: DataFrame, recovered: DataFrame | None = None, force: bool = False) -> DataFrame:
    """Pending URLs that have not been visited; recovered ones too only if ``force``."""
    left = pending.select("url").join(visited.select("url"), "url", "left_anti")
    return left if recovered is None else left.union((recovered if force else recovered.join(visited.select("url"), "url", "left_anti")).select("url")).distinct()


def merged_in_order(first: DataFrame, second: DataFrame) -> DataFrame:
    """URLs of both tables (pos, url), each once where it came first."""
    both = first.select(F.lit(0).alias("src"), "pos", "url").union(second.select(F.lit(1).alias("src"), "pos", "url"))
    nth = F.row_number().over(Window.partitionBy("url").orderBy("src", "pos"))
    return both.withColumn("nth", nth).filter("nth = 1").select("src", "pos", "url")


def checkpoint_marks(rows: DataFrame, *order: str, every: int = 10) -> DataFrame:
    """The rows after which a checkpoint is due, with their ``ordinal`` from 1 in the order.

    Rows are sorted by range; only the counts of the ranges are numbered in one place.
    """
    part = rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_part", F.spark_partition_id()).withColumn("_at", F.monotonically_increasing_id())
    inside = part.withColumn("_nth", (F.col("_at") - F.shiftleft(F.col("_part").cast("long"), 33) + 1).cast("long"))
    counts = inside.groupBy("_part").agg(F.max("_nth").alias("_n"))
    before = F.coalesce(F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = F.broadcast(counts.select("_part", before.alias("_before")))  # a row for each range
    return inside.join(starts, "_part").withColumn("ordinal", F.col("_before") + F.col("_nth")).filter(F.col("ordinal") % every == 0).drop("_part", "_at", "_nth", "_before")


def moved_or_gone(changed: DataFrame, state: DataFrame, gone_urls: DataFrame | None = None) -> DataFrame:
    """(url, category) of the old files to delete: of pages whose category changed and of pages that are gone."""
    known = state.select("url", "category")
    moved = changed.filter("moved").select("url").join(known, "url")
    return moved if gone_urls is None else moved.unionByName(known.join(gone_urls.select("url").distinct(), "url", "left_semi")).distinct()
