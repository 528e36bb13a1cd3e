"""The frontier: what to do with links, seeds, caps and crawl waves."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from webloom.functions.url import COMMON_PREFIXES, FALLBACK_PREFIXES, host_of, ignored_host, in_crawl_scope, is_asset
from webloom.plans.storage import saved


def link_actions(links: DataFrame, visited: DataFrame, blacklist: DataFrame, root: str, strict: bool = False) -> DataFrame:
    """Links (url, ...) with ``action``: fresh, blacklisted, offscope, asset or enqueue; the first that applies.

    ``visited`` has url and fresh.
    """
    seen = visited.filter("fresh").select("url", F.lit(True).alias("_fresh")).distinct()
    black = blacklist.select("url", F.lit(True).alias("_black")).distinct()
    action = (
        F.when(F.col("_fresh"), "fresh").when(F.col("_black"), "blacklisted").when(~in_crawl_scope(F.col("url"), root, strict), "offscope").when(is_asset(F.col("url")), "asset").otherwise("enqueue")
    )
    return links.join(seen, "url", "left").join(black, "url", "left").withColumn("action", action).drop("_fresh", "_black")


def next_frontier(actions: DataFrame, cap: int = 0, scanned: int = 0) -> DataFrame:
    """Distinct URLs to crawl next, in order, as many as the cap leaves after ``scanned`` pages; a cap of 0 or less is none."""
    urls = actions.filter("action = 'enqueue'").select("url").distinct()
    return urls.orderBy("url").limit(max(0, cap - scanned)) if cap > 0 else urls


def fifo_frontier(actions: DataFrame, enqueued_at: str, cap: int = 0, scanned: int = 0) -> DataFrame:
    """(url, enqueued_at) to crawl next, first in first out: each URL since it was first enqueued, ties by URL; caps as in :func:`next_frontier`."""
    queue = actions.filter("action = 'enqueue'").groupBy("url").agg(F.min(enqueued_at).alias("enqueued_at")).orderBy("enqueued_at", "url")
    return queue.limit(max(0, cap - scanned)) if cap > 0 else queue


def marked_visited(visited: DataFrame, enqueued: DataFrame, at: Column) -> DataFrame:
    """``visited`` (url, visited_ts) with the time ``at`` for every URL that is enqueued, known or not, so that none is enqueued twice."""
    now = enqueued.select("url").distinct().withColumn("visited_ts", at)
    return visited.select("url", "visited_ts").join(now.select("url"), "url", "left_anti").unionByName(now)


def first_per_host(urls: DataFrame, order: str, most: int = 10) -> DataFrame:
    """The first ``most`` URLs of each host."""
    nth = F.row_number().over(Window.partitionBy(host_of(F.col("url"))).orderBy(order, "url"))
    return urls.withColumn("nth", nth).filter(F.col("nth") <= most)


def seed_union(*sources: DataFrame) -> DataFrame:
    """Distinct hosts of all seed sources."""
    return reduce(lambda a, b: a.unionByName(b), [s.select("host") for s in sources]).distinct()


def kept_hosts(hosts: DataFrame, root: str) -> DataFrame:
    """Hosts under the root domain that are not ignored."""
    return hosts.filter(F.col("host").endswith(root) & ~ignored_host(F.col("host")))


def brute_force_hosts(spark, root: str, found: DataFrame, fewer_than: int = 10) -> DataFrame:
    """``found`` and, if there are too few, the common prefixes of the root domain."""
    own = spark.createDataFrame([(f"{p}.{root}",) for p in COMMON_PREFIXES], "host string")
    few = found.select(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") < fewer_than)
    return found.select("host").union(own.join(F.broadcast(few)).select("host")).distinct()


def seed_urls(spark, hosts: DataFrame, root: str) -> DataFrame:
    """``https`` URLs of the hosts, or those of last resort if there is no host."""
    last = spark.createDataFrame([(f"https://{p}.{root}",) for p in FALLBACK_PREFIXES], "url string")
    none = hosts.select(F.count(F.lit(1)).alias("_n")).filter("_n = 0")
    return hosts.select(F.concat(F.lit("https://"), "host").alias("url")).union(last.join(F.broadcast(none)).select("url"))


def crawl_waves(seeds: DataFrame, edges: DataFrame, waves: int = 10) -> DataFrame:
    """url and wave of every page that the seeds reach over edges (src, dst) in at most ``waves`` steps."""
    seen = saved(seeds.select("url").distinct().withColumn("wave", F.lit(0)), "wave")
    front = seen
    for k in range(1, waves + 1):
        out = front.join(edges, front["url"] == edges["src"]).select(F.col("dst").alias("url")).distinct().join(seen.select("url"), "url", "left_anti")
        front = saved(out.withColumn("wave", F.lit(k)), "wave")
        if front.isEmpty():
            break
        seen = seen.unionByName(front)
    return seen


def blacklist_filter(urls: DataFrame, blacklist: DataFrame) -> DataFrame:
    return urls.join(blacklist.select("url"), "url", "left_anti")


def missing(required: list[str], present: Column) -> Column:
    return F.array_except(F.array(*[F.lit(x) for x in required]), present)
