"""Connected components by joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .store import stored


def components(links: DataFrame) -> DataFrame:
    """(node, label) for every node of ``links`` (a, b): the smallest node that
    links lead to.  Each round takes the smallest label among the neighbours
    and then the label of that label, so long chains shrink fast."""
    edges = stored(links.select("a", "b").unionByName(
        links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "edges")
    labels = stored(edges.groupBy(F.col("a").alias("node")).agg(
        F.least(F.min("b"), F.first("a")).alias("label")), "labels")
    while True:
        near = (edges.join(labels, edges["b"] == labels["node"])
                .groupBy("a").agg(F.min("label").alias("near")))
        step = (labels.join(near, labels["node"] == near["a"])
                .select("node", "label", F.least("label", "near").alias("to")))
        jump = labels.select(F.col("node").alias("_n"), F.col("label").alias("_l"))
        new = stored(step.join(jump, step["to"] == jump["_n"], "left")
                     .select("node", F.least("to", F.coalesce("_l", "to")).alias("label"),
                             (F.least("to", F.coalesce("_l", "to")) < F.col("label"))
                             .alias("moved")), "labels")
        labels = new.select("node", "label")
        if new.filter("moved").isEmpty():
            return labels
