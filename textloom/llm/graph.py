"""Connected components of a table of links."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.llm.common import cut

MAX_ROUNDS = 60


def components(edges: DataFrame, cut: Callable[[DataFrame], DataFrame] = cut) -> DataFrame:
    """(node, component) for every node of ``edges`` (a, b); a component is named by its smallest node.

    Each round every node takes the smallest label among itself and its neighbours, and then its label's label, so chains
    halve. Minima are taken before the shuffle, so a node with many links costs its task no more than another. Rounds go
    on until no label changes; each is written to the shared folder, which cuts the lineage.
    """
    both = cut(edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    labels = cut(both.groupBy(F.col("a").alias("node")).agg(F.least(F.col("node"), F.min("b")).alias("component")))
    for _ in range(MAX_ROUNDS):
        near = both.join(labels.select(F.col("node").alias("b"), "component"), "b").groupBy(F.col("a").alias("node")).agg(F.min("component").alias("near"))
        low = labels.join(near, "node").select("node", F.col("component").alias("old"), F.least("component", "near").alias("component"))
        jump = labels.select(F.col("node").alias("component"), F.col("component").alias("next"))
        new = cut(low.join(jump, "component").select("node", F.least("component", "next").alias("component"), "old"))
        labels = new.select("node", "component")
        if new.filter(F.col("component") != F.col("old")).isEmpty():
            return labels
    raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")
