"""Connected components of a graph given by its links, as Spark joins.

Alternating large-star and small-star steps (Kiveris et al., "Connected
Components in MapReduce and Beyond", 2014): every step links a node's
neighbours to the smallest of them, which halves long chains, and is a partial
aggregation and a join on the node, so a node with very many links is split by
Spark's skewed-join handling.  The links are written to the shared folder
after each round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut


def _star(links: DataFrame, large: bool) -> DataFrame:
    both = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    near = both if large else both.filter("b < a")
    least = near.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    hop = near.join(least, "a")
    if large:
        out = hop.filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        out = hop.select(F.col("b").alias("a"), F.col("m").alias("b")).union(least.select("a", F.col("m").alias("b")))
    return out.filter("a <> b").distinct()


def components(links: DataFrame) -> DataFrame:
    """Rows (node, root) for every node of ``links`` (columns a, b): root is the smallest node of its component.

    An empty table of links gives an empty result."""
    links = cut(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct())
    mark = None
    while True:
        after = links.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("s")).first()
        if (after["n"], after["s"]) == mark or after["n"] == 0:
            break
        mark = (after["n"], after["s"])
        links = cut(_star(_star(links, large=True), large=False))
    return (links.select(F.col("a").alias("node"), F.col("b").alias("root"))
            .union(links.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()))


def joined_components(roots: DataFrame, links: DataFrame) -> DataFrame:
    """The components (node, root) after further links: only these, between roots, are followed."""
    def root_of(side):
        own = roots.select(F.col("node").alias(side), F.col("root").alias(f"{side}_root"))
        return own, F.coalesce(F.col(f"{side}_root"), F.col(side)).alias(side)
    (of_a, a), (of_b, b) = root_of("a"), root_of("b")
    top = components(links.join(of_a, "a", "left").join(of_b, "b", "left").select(a, b))
    fresh = links.select(F.col("a").alias("node")).union(links.select(F.col("b").alias("node"))).distinct()
    nodes = roots.union(fresh.join(roots, "node", "left_anti").select("node", F.col("node").alias("root")))
    top = top.select(F.col("node").alias("root"), F.col("root").alias("top"))
    return nodes.join(top, "root", "left").select("node", F.coalesce("top", "root").alias("root"))
