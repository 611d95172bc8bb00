"""Connected components of large graphs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trawl.llm.common import stored


def components(edges: DataFrame) -> DataFrame:
    """``node, component`` of every end of an edge ``a, b``; a component is named by its least node.

    Every node takes the least label among its neighbours and then the label of that label, until
    nothing changes. A round is three joins and a sum that tasks combine first; no neighbourhood is
    gathered, so a node may have any number of edges. Labels are written out between rounds.
    """
    both = F.explode(
        F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))
    )
    pairs = stored(edges.select(both.alias("e")).select("e.a", "e.b").distinct())
    labels = stored(
        pairs.groupBy(F.col("a").alias("node")).agg(
            F.least(F.first("a"), F.min("b")).alias("component")
        )
    )
    while True:
        near = (
            pairs.join(labels.withColumnRenamed("node", "b"), "b")
            .groupBy(F.col("a").alias("node"))
            .agg(F.min("component").alias("near"))
        )
        lowered = labels.join(near, "node").select(
            "node", F.col("component").alias("old"), F.least("component", "near").alias("low")
        )
        above = labels.select(F.col("node").alias("low"), F.col("component").alias("lower"))
        renamed = stored(
            lowered.join(above, "low").select(
                "node", "old", F.least("low", "lower").alias("component")
            )
        )
        labels = renamed.select("node", "component")
        if renamed.where("old <> component").isEmpty():
            return labels
