"""Connected components of a table of links, by minimum labels and pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adyield.llm.common import checkpointed_in


def component_labels(links: DataFrame) -> DataFrame:
    """Label every node of ``links`` (x, y) with the smallest node it can reach: (node, label).

    Each round takes the smallest label among the neighbours and then the label of that label, so a chain of n links needs
    about log n rounds. Rounds end when no label moves. No links give an empty table.
    """
    edges = links.select("x", "y").union(links.select("y", "x")).filter("x <> y").distinct()
    edges = checkpointed_in(edges, 2 * links.count())
    nodes = edges.select("x").distinct().count()
    labels = edges.groupBy(F.col("x").alias("node")).agg(F.least(F.col("node"), F.min("y")).alias("label"))
    labels = checkpointed_in(labels, nodes)
    while True:
        offers = (edges.join(labels.select(F.col("node").alias("x"), "label"), "x")
                  .groupBy(F.col("y").alias("node")).agg(F.min("label").alias("offer")))
        lower = checkpointed_in(labels.join(offers, "node", "left").select(
            "node", F.col("label").alias("was"), F.least("label", "offer").alias("label")), nodes)
        jump = lower.select(F.col("node").alias("label"), F.col("label").alias("further"))
        labels = lower.join(jump, "label").select("node", "was", F.least("label", "further").alias("label"))
        labels = checkpointed_in(labels, nodes)
        if not labels.filter("label < was").limit(1).count():
            return labels.select("node", "label")
        labels = labels.select("node", "label")
