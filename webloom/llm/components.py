"""Connected components of a graph given as a table of links, by contraction."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from webloom.llm.common import written_counted


def _place(node: str, turn: int) -> Column:
    """The place of a node in the random order of one round."""
    return F.struct(F.xxhash64(node, F.lit(turn)).alias("h"), F.col(node).alias("v"))


def _followed(hops: DataFrame) -> DataFrame:
    """Pointers (a, to), each followed by that of where it points to."""
    return hops.join(hops.select(F.col("a").alias("to"), F.col("to").alias("further")), "to").select("a", F.col("further").alias("to"))


def components(links: DataFrame) -> DataFrame:
    """The root (some node, the same for all of a component) of each node of ``links`` (a, b).

    Links of a node to itself and repeated ones do no harm, those with a null are
    passed over, and no links give no rows.  In each round all nodes left are ordered
    anew by a hash, every node points to the first among itself and those beside it,
    and pointers are followed for four steps; what they end at is left, with the
    links between.  A node with links stays if it comes before all beside it, which has
    a chance of one half at most whatever the labels, or if it is the end of four
    steps in falling order, one in 120.  So the number of rounds grows with the logarithm
    of the number of nodes; there is no bound on it.  The pointers of all rounds
    are followed in the end.
    """
    both = links.select("a", "b").union(links.select("b", "a")).filter("a <> b").distinct()
    edges, left = written_counted(both, "edges")
    jumps: list[DataFrame] = []
    while left:
        near = edges.groupBy("a").agg(F.min(_place("b", len(jumps))).alias("first")).select("a", F.least("first", _place("a", len(jumps)))["v"].alias("to"))
        jump = written_counted(_followed(_followed(near)), "hops")[0]
        jumps.append(jump)
        edges, left = written_counted(
            edges.join(jump, "a")
            .select(F.col("to").alias("x"), F.col("b").alias("a"))
            .join(jump, "a")
            .select(F.col("x").alias("a"), F.col("to").alias("b"))
            .filter("a <> b")
            .distinct(),
            "edges",
        )
    if not jumps:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    roots = jumps.pop()
    while jumps:  # from the last round, of the fewest nodes, to the first
        roots = jumps.pop().join(roots.select(F.col("a").alias("to"), F.col("to").alias("root")), "to", "left").select("a", F.coalesce("root", "to").alias("to"))
        roots = roots if len(jumps) % 4 else written_counted(roots, "roots")[0]
    return roots.select(F.col("a").alias("node"), F.col("to").alias("root"))
