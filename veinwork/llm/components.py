"""Connected components of an edge table, by contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veinwork.session import discard, durable


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of `edges` (columns a, b): the least node reachable.

    Each round hooks every node to its least smaller neighbour, follows those hooks to their
    roots by doubling, and goes on with the distinct edges between roots, of which each round
    leaves at most half as many nodes. Minima are aggregated before the shuffle, and edges meet
    hooks in joins that adaptive execution splits, so a node with very many edges is no hot spot.
    Self-loops and repeated edges are harmless. The result is a stored table.
    """
    least, most = F.least("a", "b").alias("b"), F.greatest("a", "b").alias("a")
    nodes = edges.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    labels = durable(nodes.withColumn("component", F.col("node")))
    left = durable(edges.select(most, least).filter("a > b").distinct())
    while not left.isEmpty():
        hooks = followed = durable(left.groupBy("a").agg(F.min("b").alias("root")))
        while True:
            further = hooks.select(F.col("a").alias("root"), F.col("root").alias("beyond"))
            moved = durable(hooks.join(further, "root", "left").select(
                "a", F.coalesce("beyond", "root").alias("root"), F.col("beyond").isNotNull().alias("moved")
            ))
            discard(followed)
            followed, hooks = moved, moved.select("a", "root")
            if moved.filter("moved").isEmpty():
                break
        to = hooks.select(F.col("a").alias("component"), "root")
        renamed = durable(
            labels.join(to, "component", "left").select("node", F.coalesce("root", "component").alias("component"))
        )
        discard(labels)
        labels = renamed
        one = left.join(hooks.withColumnRenamed("root", "ra"), "a", "left").select(F.coalesce("ra", "a").alias("a"), "b")
        two = one.join(hooks.select(F.col("a").alias("b"), F.col("root").alias("rb")), "b", "left")
        both = two.select("a", F.coalesce("rb", "b").alias("b"))
        further = durable(both.select(most, least).filter("a > b").distinct())
        discard(left, followed)
        left = further
    discard(left)
    return labels
