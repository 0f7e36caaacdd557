"""Connected components of a graph that Spark holds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import stored


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``label`` (the smallest node it reaches) of each node of the edges ``a``, ``b``.

    Each round takes the smallest label among a node's neighbours, then the label's own label, so
    distances shrink by half or better. Every round is stored; a node with many
    neighbours is pre-aggregated before its shuffle."""
    both = stored(edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
                  .filter("a != b").distinct(), "edges")
    labels = stored(both.groupBy(F.col("a").alias("node")).agg(F.least(F.col("node"), F.min("b")).alias("label")),
                    "labels")
    while True:
        of = labels.select(F.col("node").alias("b"), F.col("label").alias("near"))
        least = both.join(of, "b").groupBy(F.col("a").alias("node")).agg(F.min("near").alias("near"))
        step = stored(labels.join(least, "node").select(
            "node", F.col("label").alias("old"), F.least("label", "near").alias("label")), "labels-near")
        up = step.select(F.col("node").alias("label"), F.col("label").alias("top"))
        labels = stored(step.join(up, "label").select("node", "old", F.col("top").alias("label")), "labels")
        if labels.filter("label != old").isEmpty():
            return labels.select("node", "label")
        labels = labels.select("node", "label")
