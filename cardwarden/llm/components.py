"""Connected components of a graph of bounded degree, by hooking and shortcutting."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardwarden.sources.scratch import materialize


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) of every node with an edge; the root is the smallest node it can reach.

    Each round every edge offers the root of one end to the other end and to that end's own
    root, and every node takes its root's root: the rounds grow with the logarithm of the
    longest path. Offers are reduced to their minimum before each shuffle, so a root with
    very many nodes costs one row a task; looking up roots' roots joins two written tables,
    where Spark splits a hot root. Each round is written and read again.
    """
    both = edges.select(F.col(a).alias("u"), F.col(b).alias("v"))
    both = both.unionByName(both.select(F.col("v").alias("u"), F.col("u").alias("v")))
    both = materialize(both.where("u != v").distinct(), "links")
    roots = materialize(
        both.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("_v"))
        .select("node", F.least("node", "_v").alias("root")), "roots",
    )
    while True:
        of_u = roots.select(F.col("node").alias("u"), F.col("root").alias("ru"))
        of_v = roots.select(F.col("node").alias("v"), F.col("root").alias("rv"))
        seen = both.join(of_v, "v").groupBy("u").agg(F.min("rv").alias("rv")).join(of_u, "u")
        up = roots.join(
            roots.select(F.col("node").alias("root"), F.col("root").alias("top")), "root"
        )
        offers = (
            seen.select(F.col("u").alias("node"), F.col("rv").alias("root"))
            .unionByName(seen.where("rv < ru").select(F.col("ru").alias("node"), F.col("rv").alias("root")))
            .unionByName(up.select("node", F.col("top").alias("root")))
        )
        least = offers.groupBy("node").agg(F.min("root").alias("_new"))
        grown = materialize(
            roots.join(least, "node", "left")
            .select("node", F.least("root", "_new").alias("root"), (F.col("_new") < F.col("root")).alias("moved")),
            "roots",
        )
        roots = grown.select("node", "root")
        if grown.where("moved").limit(1).count() == 0:
            return roots
