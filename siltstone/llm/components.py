"""Connected components of a graph given by its links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone.llm.tables import few_parts, materialize


def connected_components(links: DataFrame) -> DataFrame:
    """(node, label) for each node in a link (a, b); label is the smallest reached.

    Each round, nodes and their parents take the smallest label next to them, then
    follow their label once. The number of rounds grows with the logarithm of the
    longest path. Labels are stored after each round, which cuts the lineage and
    survives lost executors; only the number of changes reaches the driver.
    """
    ways = F.explode(F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b"))))
    edges = materialize(links.select(ways.alias("way")).select("way.*"))
    # There are no more nodes than edges, as each link is there both ways.
    most = edges.count()
    labels = edges.groupBy(F.col("a").alias("node")).agg(
        F.least(F.min("b"), F.first("a")).alias("label")
    )
    labels = materialize(few_parts(labels, most))
    while True:
        beside = edges.join(labels, edges["b"] == labels["node"]).select("a", "label")
        lowest = beside.groupBy(F.col("a").alias("node")).agg(F.min("label").alias("low"))
        known = labels.join(lowest, "node")
        offers = known.select(
            "node", F.least("label", "low").alias("new"), F.col("label").alias("old")
        ).unionAll(
            known.filter("low < label").select(
                F.col("label").alias("node"),
                F.col("low").alias("new"),
                F.lit(None).cast("long").alias("old"),
            )
        )
        hooked = offers.groupBy("node").agg(
            F.min("new").alias("new"), F.min("old").alias("old")
        )
        parent = hooked.select(F.col("node").alias("new"), F.col("new").alias("label"))
        jumped = hooked.join(parent, "new").select("node", "label", "old")
        jumped = materialize(few_parts(jumped, most))
        labels = jumped.select("node", "label")
        if jumped.filter("label < old").isEmpty():
            return labels
