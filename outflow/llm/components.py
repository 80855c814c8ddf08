"""Connected components of a link table, by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from outflow.llm.shared import staged, unstage


def _meet(edges: DataFrame, least: DataFrame) -> DataFrame:
    """Edges with the least neighbour (m) of their first node.

    The least neighbours are a table of their own, so that this is a plain join,
    in which Spark can split a node that very many edges share.
    """
    return edges.join(least.withColumnRenamed("a", "node"), F.col("a") == F.col("node")).drop("node")


def components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """(node, root) for every node on an edge; root is the least node reachable.

    ``edges``: long columns a, b.  Each round first moves every node's larger
    neighbours to its least neighbour, then every node and its smaller
    neighbours to the least of them.  Rounds are written to the shared folder,
    so a lost executor costs one round; the driver sees two numbers a round.
    """
    now = staged(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    before = None
    for _ in range(most_rounds):
        state = now.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.bit_xor(F.xxhash64("a", "b")), F.lit(0)).alias("x")).first()
        if state["n"] == 0 or state == before:
            return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("root"))).distinct()
        before = state
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = staged(both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m")), "least")
        large = staged(_meet(both.where("b > a"), least).select(F.col("b").alias("a"), F.col("m").alias("b")), "large")
        fewer = staged(large.groupBy("a").agg(F.min("b").alias("m")), "least")
        moved = _meet(large, fewer).where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        after = staged(moved.unionByName(fewer.select("a", F.col("m").alias("b"))).distinct(), "edges")
        unstage(now, least, large, fewer)
        now = after
    raise RuntimeError(f"components did not settle in {most_rounds} rounds")
