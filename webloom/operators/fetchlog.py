"""What a fetch log (FETCH_LOG rows) says: outcomes, counters, back-off and politeness."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: Seconds to wait after the first, second and every later attempt.
BACKOFF = [30, 60, 120]
ATTEMPTS = 4


def fetch_action(status: Column, attempt: Column) -> Column:
    """``return`` on 200, else ``retry``, and ``blacklist`` on the last attempt; a null status is a network error."""
    return F.when(F.coalesce(status, F.lit(0)) == 200, "return").when(attempt >= ATTEMPTS, "blacklist").otherwise("retry")


def backoff(attempt: Column) -> Column:
    return F.element_at(F.array(*[F.lit(x) for x in BACKOFF]), F.greatest(F.lit(1), F.least(attempt, F.lit(len(BACKOFF)))).cast("int"))


def outcomes(log: DataFrame) -> DataFrame:
    """For each URL: attempts, last status, what follows, and the wait before it."""
    last = log.groupBy("url").agg(F.max("attempt").alias("attempts"), F.max_by("status", "attempt").alias("status"))
    action = fetch_action(F.col("status"), F.col("attempts"))
    return last.withColumn("action", action).withColumn("wait", F.when(action == "retry", backoff(F.col("attempts"))))


def failure_reason(status: Column, error: Column) -> Column:
    return F.when(error.isNotNull(), "network_error").when(status != 200, F.concat(F.lit("http_"), status.cast("string")))


def counters(rows: DataFrame, reason: str) -> DataFrame:
    """How often each reason occurs, most often first; null reasons don't count."""
    return rows.filter(F.col(reason).isNotNull()).groupBy(F.col(reason).alias("reason")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "reason")


def html_gate(html: Column) -> Column:
    """``process``, ``html_too_short`` or ``empty_html``."""
    return F.when(F.coalesce(F.length(html), F.lit(0)) == 0, "empty_html").when(F.length(html) > 100, "process").otherwise("html_too_short")


def schedule(arrivals: DataFrame, host: str, arrival: str, delay: float, *tie: str, block: float = 3600.0) -> DataFrame:
    """Add ``slot``, the second at which each request may go: its arrival, or ``delay`` after the one before on its host.

    slot = max over the requests so far of (arrival - delay * place) + delay * place.
    Requests of a host are numbered in blocks of so many seconds, and only the count and
    the maximum of each block are carried on, so a busy host is the work of many tasks.
    """
    order = Window.partitionBy(host, "_block").orderBy(arrival, *tie)
    rows = arrivals.withColumn("_block", F.floor(F.col(arrival) / block)).withColumn("_place", F.row_number().over(order))
    rows = rows.withColumn("_lead", F.col(arrival) - delay * F.col("_place"))
    blocks = rows.groupBy(host, "_block").agg(F.count(F.lit(1)).alias("_n"), F.max("_lead").alias("_top"))
    ahead = Window.partitionBy(host).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.withColumn("_before", F.coalesce(F.sum("_n").over(ahead), F.lit(0)))
    blocks = blocks.withColumn("_carried", F.max(F.col("_top") - delay * F.col("_before")).over(ahead)).select(F.col(host).alias("_host"), F.col("_block").alias("_b"), "_before", "_carried")
    upto = order.rowsBetween(Window.unboundedPreceding, 0)
    own = F.max("_lead").over(upto) - delay * F.col("_before")
    met = rows.join(blocks, rows[host].eqNullSafe(blocks["_host"]) & rows["_block"].eqNullSafe(blocks["_b"]))
    return met.withColumn("slot", F.greatest(own, "_carried") + delay * (F.col("_place") + F.col("_before"))).select(*arrivals.columns, "slot")


def dns_gate(log: DataFrame, most: int = 3) -> DataFrame:
    """For each domain of a log (domain, at, ok): failures since the last success, and whether it is still asked."""
    good = log.groupBy("domain").agg(F.max(F.when(F.col("ok"), F.col("at"))).alias("_last"))
    since = log.join(good, "domain").groupBy("domain").agg(F.count_if(~F.col("ok") & (F.col("_last").isNull() | (F.col("at") > F.col("_last")))).alias("failures"))
    return since.withColumn("alive", F.col("failures") < most)
