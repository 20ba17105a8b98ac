"""Connected components of a graph given as edges, by large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keelson.llm.common import store


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Link every neighbour on one side of a node to the smallest of its neighbourhood.

    ``edges`` has a > b; so has the result, possibly with repeated rows. A node with very many
    neighbours is left to AQE, which splits its part of the join (serving such nodes by broadcast
    costs more small stages a round than it saves)."""
    ways = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))
                             ) if large else edges
    least = ways.groupBy("a").agg(F.min("b").alias("least")).withColumn(
        "least", F.least("a", "least"))
    near = ways.join(least, "a")
    near = near.filter("b > a") if large else near.unionByName(
        least.select("a", F.col("a").alias("b"), "least"))
    return near.select(F.col("b").alias("a"), F.col("least").alias("b")).filter("a <> b")


def components(edges: DataFrame, rounds: int = 50) -> DataFrame:
    """(node, label): the smallest node reachable, for every node that has an edge.

    ``edges`` has (a, b), any order. Each round is written to the shared scratch folder.
    Ends when a round changes nothing: then every node hangs on its component's smallest.
    """
    # equal as sets when the counts and the sums of hashes agree
    mark = lambda df: df.agg(F.count(F.lit(1)), F.sum(
        F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    now = store(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                .filter("a <> b").distinct(), "component_edges")
    before = mark(now)
    for _ in range(rounds):
        if not before[0]:
            break
        now = store(_star(_star(now, True), False).distinct(), "component_edges")
        after = mark(now)
        if after == before:
            break
        before = after
    else:
        raise RuntimeError(f"components not settled in {rounds} rounds")
    nodes = now.select(F.col("a").alias("node"), F.col("b").alias("label"))
    return nodes.unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("label"))
                             .distinct())
