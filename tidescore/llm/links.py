"""Connected components of a graph given as an edge table, by repeated contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidescore.session import scratch_table


def tidy(edges: DataFrame) -> DataFrame:
    pairs = edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    return scratch_table(pairs.where(F.col("a") < F.col("b")).distinct(), "edges")


def followed(hooks: DataFrame) -> DataFrame:
    """Hooks (from, to) followed to the ends of their chains, twice as far with each join."""
    while True:
        on = hooks.toDF("next", "beyond")
        longer = scratch_table(
            hooks.join(on, F.col("to") == F.col("next"), "left").select(
                "from", F.coalesce("beyond", "to").alias("to"), F.col("beyond").isNotNull().alias("moved")),
            "hooks")
        hooks = longer.select("from", "to")
        if longer.where("moved").isEmpty():
            return hooks


def components(edges: DataFrame) -> DataFrame:
    """`edges` (a, b: long) -> one row (node, root) per node that has an edge; root is the smallest node reached.

    Each round hooks every node with a smaller neighbour to its smallest one, follows the hooks to
    their ends and renames the edges. What is left are nodes without a smaller neighbour: at most half
    of those that had an edge, and always the smallest of a component. Chains are followed by
    doubling, so neither long chains nor hubs take many rounds. Tables are written each time, which
    also lets adaptive execution split the rows of a hub.
    """
    left = tidy(edges)
    nodes = left.select(F.col("a").alias("node")).union(left.select("b")).distinct()
    named = nodes.withColumn("root", F.col("node"))
    while not left.isEmpty():
        hooks = followed(left.groupBy(F.col("b").alias("from")).agg(F.min("a").alias("to")))
        first, second = hooks.toDF("from_a", "to_a"), hooks.toDF("from_b", "to_b")
        named = scratch_table(
            named.join(first, F.col("root") == F.col("from_a"), "left").select(
                "node", F.coalesce("to_a", "root").alias("root")),
            "named")
        left = tidy(
            left.join(first, F.col("a") == F.col("from_a"), "left").join(second, F.col("b") == F.col("from_b"))
            .select(F.coalesce("to_a", "a").alias("a"), F.col("to_b").alias("b"))
        )
    return named
