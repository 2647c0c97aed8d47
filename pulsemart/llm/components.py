"""Connected components of a link table, by label passing with pointer jumps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsemart.llm.common import stored


def components(links: DataFrame) -> DataFrame:
    """(``node``, ``root``) for every node of ``links`` (``a``, ``b``); the root is
    the smallest node reachable.

    Each round takes the least label among a node's neighbours and then the
    label of its label.  Labels are written once a round, so a round reads files
    on both sides of its joins and a node with many links is split by Spark's
    skewed-join handling.  A link table without rows gives no nodes.
    """
    pairs = links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    pairs = stored(pairs, "component_links")
    labels = stored(pairs.groupBy("a").agg(F.min("b").alias("m")).select(
        F.col("a").alias("node"), F.least("a", "m").alias("root")), "component_labels")
    while True:
        near = pairs.join(labels.withColumnRenamed("node", "b"), "b").groupBy("a").agg(F.min("root").alias("m"))
        lower = stored(labels.join(near, F.col("node") == F.col("a")).select(
            "node", F.least("root", "m").alias("root"), (F.col("m") < F.col("root")).alias("moved")), "component_step")
        target = lower.select(F.col("node").alias("t"), F.col("root").alias("deeper"))
        jumped = stored(lower.join(target, F.col("root") == F.col("t")).select(
            "node", F.col("deeper").alias("root"), (F.col("moved") | (F.col("deeper") < F.col("root"))).alias("moved")),
            "component_labels")
        if not jumped.filter("moved").limit(1).count():
            return jumped.select("node", "root")
        labels = jumped.select("node", "root")
