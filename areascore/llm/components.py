"""Connected components by alternating large-star and small-star.

Large-star: every node ties its larger neighbours to the smallest node it sees. Small-star: every
node ties its smaller neighbours to the smallest of them. Alternated until nothing changes, every
node hangs on the smallest node of its component. Each star is a minimum with a partial step and
a join; no neighbourhood is ever collected, and the rounds grow with the logarithm of the nodes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from areascore.llm.batches import Kept


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
    return both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Edges from a larger node ``a`` to a smaller one ``b``; the edge to the smallest ties the node itself."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    tied = F.when(F.col("b") > F.col("m"), F.col("b")).otherwise(F.col("a"))
    return edges.join(least, "a").select(tied.alias("a"), F.col("m").alias("b")).distinct()


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b") % 1_000_000_007), F.sum("b")).first())


def connected_components(links: DataFrame) -> DataFrame:
    """id and component, the smallest id of its component, of every node of ``links`` (a, b: long).

    Links to null or to the node itself tie nothing. An empty frame has no nodes.
    """
    keep = Kept(links.sparkSession)
    edges = links.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    edges = keep(edges.distinct(), "edges")
    before = _state(edges)
    while before[0]:
        edges = keep(_small_star(keep(_large_star(edges), "stars")), "edges")
        after = _state(edges)
        if after == before:
            break
        before = after
    roots = edges.select(F.col("b").alias("id"), F.col("b").alias("component")).distinct()
    return edges.select(F.col("a").alias("id"), F.col("b").alias("component")).unionAll(roots)
