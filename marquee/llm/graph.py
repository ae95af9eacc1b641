"""Connected components by the smallest label, as DataFrame rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.llm.common import stored


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for all nodes of ``edges`` (a, b); root is the smallest node reachable.

    Each round takes the smallest label among the neighbours and then that
    label's own label, so that long chains need few rounds. State is written
    after each round; on the driver is only whether something changed.
    """
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()
    both = stored(both, "components-edges")
    labels = stored(both.groupBy(F.col("a").alias("node")).agg(F.least(F.col("a"), F.min("b")).alias("root")), "components")
    while True:
        near = both.join(labels.withColumnRenamed("node", "b"), "b").groupBy(F.col("a").alias("node")).agg(F.min("root").alias("near"))
        step = stored(labels.join(near, "node").select("node", F.col("root").alias("old"), F.least("root", "near").alias("root")), "components")
        own = step.select(F.col("node").alias("root"), F.col("root").alias("next"))
        jumped = step.join(own, "root").select("node", "old", F.least("root", "next").alias("root"))
        labels = stored(jumped, "components")
        if labels.where(F.col("old") != F.col("root")).isEmpty():
            return labels.select("node", "root")
        labels = labels.select("node", "root")
