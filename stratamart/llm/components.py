"""Connected components of a graph of links, as Spark joins: alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratamart.llm.common import materialise


def _large_star(edges: DataFrame) -> DataFrame:
    """Link every larger neighbour of a node to the smallest of its neighbours and itself."""
    both = edges.union(edges.select(F.col("b"), F.col("a")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")


def _small_star(edges: DataFrame) -> DataFrame:
    """Link a node and its smaller neighbours to the smallest of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    others = down.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return others.union(least.select("a", F.col("m").alias("b"))).where("a <> b").distinct()


def connected_components(edges: DataFrame) -> DataFrame:
    """From links (a, b) the rows (node, root) of every linked node; the root is the component's least node.

    Each round is written to the shared folder, so lost executors repeat one round at most. The rounds
    grow with the logarithm of the longest chain. The driver sees a count and a checksum per round.
    """
    edges = materialise(edges.select("a", "b").where("a <> b").distinct(), "links")
    seen = None
    while True:
        state = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("s")).first()
        if (state["n"], state["s"]) == seen:
            break
        seen = (state["n"], state["s"])
        if not seen[0]:
            break
        edges = materialise(_small_star(_large_star(edges)), "stars")
    nodes = edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return nodes.union(edges.select(F.col("b"), F.col("b"))).distinct()


class Forest:
    """Union-find over the places of a small array, for use inside a task."""

    def __init__(self, size: int) -> None:
        self.parent = list(range(size))

    def root(self, at: int) -> int:
        parent = self.parent
        while parent[at] != at:
            parent[at] = parent[parent[at]]
            at = parent[at]
        return at

    def join(self, a: int, b: int) -> None:
        a, b = self.root(a), self.root(b)
        if a != b:
            self.parent[max(a, b)] = min(a, b)
