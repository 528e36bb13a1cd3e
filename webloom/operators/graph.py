"""The link graph and PageRank over it.

Links are a multigraph: repeats of a link count as often as they occur, above and
below the line.  Rank that reaches a page without links is spread over all pages.
Ranks start at 1 and sum up to the number of nodes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from webloom.plans.storage import saved


def link_edges(pages: DataFrame) -> DataFrame:
    """(src, dst) of every link of PAGE rows, repeats included; pages without URL have none."""
    return pages.filter(F.col("url") != "").select(F.col("url").alias("src"), F.explode("links").alias("dst"))


def node_set(pages: DataFrame, edges: DataFrame) -> DataFrame:
    """Distinct ids of pages and link targets."""
    return pages.filter(F.col("url") != "").select(F.col("url").alias("id")).union(edges.select("src")).union(edges.select("dst")).distinct()


def out_degrees(edges: DataFrame) -> DataFrame:
    return edges.groupBy("src").agg(F.count(F.lit(1)).alias("out_degree"))


def dangling(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """Nodes without links of their own."""
    return nodes.join(edges.select(F.col("src").alias("id")).distinct(), "id", "left_anti")


def pagerank(nodes: DataFrame, edges: DataFrame, damping: float = 0.85, most: int = 20, epsilon: float = 1e-6) -> DataFrame:
    """id and rank after at most ``most`` rounds, or once no rank moves by ``epsilon``.

    Repeats of a link are counted first and stand as a weight.  Each round is a join
    on the source, a sum by target with partial sums, and one write; the dangling
    mass of the next round and the largest move come from one aggregate.
    """
    weights = edges.groupBy("src", "dst").agg(F.count(F.lit(1)).alias("k"))
    shares = saved(weights.join(out_degrees(edges), "src").select("src", "dst", (F.col("k") / F.col("out_degree")).alias("share")), "shares")
    ends = nodes.join(shares.select(F.col("src").alias("id"), F.lit(False).alias("ends")).distinct(), "id", "left").select("id", F.coalesce("ends", F.lit(True)).alias("ends"))
    ranks = saved(ends.select("id", "ends", F.lit(1.0).alias("rank")), "ranks")
    sums = ranks.agg(F.count(F.lit(1)), F.sum(F.when(F.col("ends"), F.col("rank")))).first()
    n, lost = sums[0], sums[1] or 0.0
    for _ in range(most):
        got = shares.join(ranks.select(F.col("id").alias("src"), "rank"), "src").groupBy(F.col("dst").alias("id")).agg(F.sum(F.col("rank") * F.col("share")).alias("got"))
        base = (1 - damping) + damping * lost / max(1, n)
        after = ranks.join(got, "id", "left").select("id", "ends", (F.lit(base) + damping * F.coalesce("got", F.lit(0.0))).alias("rank"), F.col("rank").alias("old"))
        after = saved(after, "ranks")
        moved, lost = after.agg(F.max(F.abs(F.col("rank") - F.col("old"))), F.sum(F.when(F.col("ends"), F.col("rank")))).first()
        ranks, lost = after.select("id", "ends", "rank"), lost or 0.0
        if moved is None or moved < epsilon:
            break
    return ranks.select("id", "rank")


def top_ranks(ranks: DataFrame, n: int = 10) -> DataFrame:
    return ranks.orderBy(F.desc("rank"), "id").limit(n)


def rank_lines(ranks: DataFrame) -> DataFrame:
    """Lines ``rank TAB id`` with six decimals, highest first."""
    return ranks.orderBy(F.desc("rank"), "id").select(F.format_string("%.6f\t%s", "rank", "id").alias("value"))
