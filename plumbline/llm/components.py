"""Connected components of a graph whose edges are a DataFrame."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.llm.common import stored


def _settled(edges: DataFrame) -> bool:
    """Whether every edge (a, b), with a > b, leads from a node without other edges to a root."""
    ends = edges.select(F.col("a").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionAll(
        edges.select(F.col("b").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down")))
    open_nodes = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down")).filter("up + down > 1 and up > 0")
    return open_nodes.isEmpty()


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``root``, the least node that it is linked to, for every node of ``edges`` (a, b longs).

    Large-star and small-star steps in turn: each node gives its neighbours the least node that it knows, until
    every node hangs below a root; one count by node shows that, where another round without change would cost
    all steps. Every step is a minimum by key, which tasks combine before the shuffle, and a join back to
    the edges, whose heavy keys the join can split. No list of neighbours is ever built. After each round the
    edges are written to the shared folder.
    """
    current = stored(
        edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    while not _settled(current):
        # Large star: larger neighbours of a node are hung below the least of its neighbours and itself.
        both = current.unionAll(current.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        # Small star: smaller neighbours and the node itself are hung below the least smaller neighbour.
        down = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(down, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).unionAll(
            down.select("a", F.col("m").alias("b"))).filter("a <> b").distinct()
        current = stored(small, "edges")
    return current.select(F.col("a").alias("node"), F.col("b").alias("root"))
