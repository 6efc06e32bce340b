"""Connected components of an edge table, by minimum labels with pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ledgerlake.llm.common import Workspace


def connected(space: Workspace, edges: DataFrame, name: str) -> DataFrame:
    """``node``, ``label`` of every node in ``edges`` (``a``, ``b``); nodes in one component share a label.

    Each round takes the least label among the neighbours and then the label's own label, so that the
    number of rounds grows with the logarithm of a component's diameter. A hub with very many
    neighbours is reduced in the map tasks, and its joins are between kept tables, which can be split.
    """
    both = edges.select("a", "b").where("a <> b")
    both = space.keep(both.unionByName(both.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), f"{name}-edges")
    labels = space.keep(
        both.groupBy("a").agg(F.min("b").alias("low")).select(F.col("a").alias("node"), F.least("a", "low").alias("label")),
        f"{name}-0")
    turn = 0
    while True:
        near = both.join(labels, both["b"] == labels["node"]).groupBy("a").agg(F.min("label").alias("low"))
        lower = labels.join(near, labels["node"] == near["a"]).select(
            "node", F.col("label").alias("old"), F.least("label", "low").alias("label"))
        # The label that the new label's node had before this round lies in the same component.
        roots = labels.select(F.col("node").alias("root"), F.col("label").alias("next"))
        moved = space.keep(
            lower.join(roots, lower["label"] == roots["root"], "left")
            .select("node", "old", F.least("label", F.coalesce("next", "label")).alias("label")), f"{name}-{turn + 1}")
        space.drop(f"{name}-{turn}")
        labels, turn = moved.select("node", "label"), turn + 1
        if moved.where("old <> label").isEmpty():
            return labels
