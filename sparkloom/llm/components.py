"""Connected components over an edge table, with no hub in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkloom.scratch import cut, drop


def connected_components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """``id, label`` of every node of ``edges(u, v)``; label is the component's smallest id.

    Minimum-label propagation over both directions with a pointer jump in each
    round, so the rounds follow the logarithm of the diameter. Aggregations
    combine before the shuffle; the joins have plain exchanges on both sides,
    which adaptive execution splits where a node has very many edges.
    """
    both = cut(edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))).where("u <> v"), "edges")
    labels = cut(both.groupBy(F.col("u").alias("id")).agg(F.least(F.min("v"), F.first("u")).alias("label")), "labels")
    for _ in range(rounds):
        near = both.join(labels, F.col("v") == F.col("id")).groupBy("u").agg(F.min("label").alias("near"))
        low = cut(labels.join(near, F.col("id") == F.col("u")).select("id", F.least("label", "near").alias("label"), F.col("label").alias("old")), "low")
        jump = low.select(F.col("id").alias("at"), F.col("label").alias("further"))
        new = cut(low.join(jump, F.col("label") == F.col("at")).select("id", "old", F.least("label", "further").alias("label")), "labels")
        changed = new.where("old <> label").limit(1).count()
        drop(low)
        drop(labels)
        labels = new.select("id", "label")
        if not changed:
            return labels
    raise RuntimeError(f"components did not settle in {rounds} rounds")
