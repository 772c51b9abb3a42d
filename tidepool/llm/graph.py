"""Connected components over an edge table by large-star / small-star
rounds (Kiveris et al., 2014): joins and aggregations only, every round
written to the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidepool.llm.shared import BROADCAST_ROWS, semi_join, written


def _is_star(e: DataFrame) -> bool:
    """Each edge leads from a node of one edge to a root, which is no child."""
    ends = e.select(F.col("u").alias("x"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionByName(
        e.select(F.col("v").alias("x"), F.lit(0).alias("up"), F.lit(1).alias("down")))
    per_node = ends.groupBy("x").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return not per_node.agg(F.max((F.col("up") + F.col("down")) > 1)).first()[0]


def components(edges: DataFrame, src: str, dst: str) -> DataFrame:
    """(node, root) for every node of the undirected edges; root is the
    smallest node reachable. Self-loops and null ends are ignored; an empty
    edge table gives an empty result. Each round links neighbours to the
    smallest neighbour, so long chains need about log(length) rounds; they end
    when every node is linked to its root alone."""
    a, b = F.col(src).cast("long"), F.col(dst).cast("long")
    e = (edges.where(a.isNotNull() & b.isNotNull() & (a != b))
         .select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct())
    e = written(e, "edges")
    while not _is_star(e):
        down = e.select(F.col("v").alias("u"), F.col("u").alias("v"))
        # written, so that its rows are counted: within the bound a node with
        # many neighbours is not shuffled, beyond it AQE can split its rows
        low = written(e.unionByName(down).groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m")), "lowest")
        n = low.count()  # every node; least has no more rows
        large = semi_join(down, "u", low, n, extra=True).select(F.col("v").alias("u"), F.col("m").alias("v"))
        if n > BROADCAST_ROWS:  # combined before it is shuffled
            large = large.distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (semi_join(large, "u", least, n, extra=True).where(F.col("v") != F.col("m"))
                 .select(F.col("v").alias("u"), F.col("m").alias("v")))
        e = written(small.unionByName(least.select("u", F.col("m").alias("v"))).distinct(), "edges")
    roots = e.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.unionByName(e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


def sized_components(edges: DataFrame, src: str, dst: str) -> DataFrame:
    """``components`` with the ``size`` of each node's component."""
    comp = written(components(edges, src, dst), "components")
    sizes = comp.groupBy("root").agg(F.count("*").alias("size"))
    return semi_join(comp, "root", sizes, comp.count(), extra=True)  # there are fewer roots than nodes
