"""Connected components by label propagation with pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import Scratch, maybe_broadcast


def connected_components(edges: DataFrame, scratch: Scratch, tag: str) -> DataFrame:
    """(node, component) of every node of ``edges`` (a long, b long); a
    component's name is its smallest node.

    Each round takes every node's least label among itself and its neighbours,
    then the label of that label, so paths halve. All steps are joins and
    partially aggregated minima on fixed-width columns: a node with very many
    neighbours is reduced before its rows are shuffled. Labels are broadcast
    while they are few, else joined by shuffles that are split when skewed. Null ends are ignored; no edges give no rows.
    """
    edges = edges.where("a is not null and b is not null and a <> b")
    both = scratch.save(edges.select("a", "b").union(edges.select(F.col("b"), F.col("a"))).distinct(), f"{tag}-edges")
    labels = scratch.save(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m"))
                          .select("node", F.least("node", "m").alias("component")), f"{tag}-0")
    step = 0
    while True:
        labels = maybe_broadcast(labels)
        near = (both.join(labels, both["b"] == labels["node"]).groupBy(F.col("a").alias("n"))
                .agg(F.min("component").alias("near")))
        lowered = (labels.join(near, labels["node"] == near["n"])
                   .select("node", F.col("component").alias("was"), F.least("component", "near").alias("low")))
        jump = labels.select(F.col("node").alias("j"), F.col("component").alias("jumped"))
        new = (lowered.join(jump, lowered["low"] == jump["j"], "left")
               .select("node", "was", F.least("low", F.coalesce("jumped", "low")).alias("component")))
        step += 1
        new = scratch.save(new, f"{tag}-{step}")
        done = new.where("was <> component").isEmpty()
        scratch.drop(f"{tag}-{step - 1}")
        labels = new.select("node", "component")
        if done:
            return labels
