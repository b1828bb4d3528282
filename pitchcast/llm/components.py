"""Connected components of a graph given as a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for each node of ``edges`` (columns a, b): the smallest node that can be reached.

    Labels fall to the smallest label of a neighbour, then to their label's own
    label, so rounds grow with the logarithm of a chain's length. Every round is
    stored; only one flag per round comes to the driver.
    """
    both = stored(edges.select("a", "b").union(edges.select(F.col("b"), F.col("a"))).where("a <> b").distinct(), "edges")
    labels = stored(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("label"))
                    .withColumn("moved", F.lit(True)), "labels")
    while labels.agg(F.max("moved")).first()[0]:
        to = labels.select(F.col("node").alias("to"), F.col("label").alias("to_label"))
        jumped = labels.join(to, F.col("label") == F.col("to")).select("node", F.col("label").alias("was"), F.col("to_label").alias("label"))
        near = (both.join(jumped.select("node", "label"), F.col("a") == F.col("node"))
                .groupBy(F.col("b").alias("near")).agg(F.min("label").alias("near_label")))
        labels = stored(jumped.join(near, F.col("node") == F.col("near"), "left")
                        .select("node", "was", F.least("label", "near_label").alias("label"))
                        .select("node", "label", (F.col("label") != F.col("was")).alias("moved")), "labels")
    return labels.select("node", F.col("label").alias("component"))
