"""Connected components of links between documents, without gathering anything on the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written


def components(links: DataFrame) -> DataFrame:
    """links (a, b) to (node, label): label is the smallest node of the component. Nodes without links have no row.

    Every round each node takes the smallest label among itself and its
    neighbours, and then the label of that label, so chains halve. Each round is
    a written table; only its count of changes reaches the driver.
    """
    both = written(links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).where("a != b").distinct())
    labels = written(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m")).select("node", F.least("node", "m").alias("label")))
    while True:
        near = both.join(labels.select(F.col("node").alias("b"), "label"), "b").groupBy(F.col("a").alias("node")).agg(F.min("label").alias("m"))
        one = labels.join(near, "node").select("node", F.col("label").alias("was"), F.least("label", "m").alias("label"))
        to = labels.select(F.col("node").alias("n2"), F.col("label").alias("far"))
        step = written(one.join(to, one["label"] == to["n2"], "left").select("node", "was", F.least("label", F.coalesce("far", "label")).alias("label")))
        changed = step.where("was != label").limit(1).count()
        labels = step.select("node", "label")
        if not changed:
            return labels


def joined(labels: DataFrame, links: DataFrame) -> DataFrame:
    """labels after more links: only the components that these join are looked at, each as one node."""
    of = lambda c: labels.select(F.col("node").alias(f"{c}_node"), F.col("label").alias(f"{c}_label"))
    both = links.join(of("a"), F.col("a") == F.col("a_node"), "left").join(of("b"), F.col("b") == F.col("b_node"), "left")
    ends = written(both.select("a", "b", F.coalesce("a_label", "a").alias("x"), F.coalesce("b_label", "b").alias("y")))
    if ends.isEmpty():
        return labels
    merged = components(ends.select(F.col("x").alias("a"), F.col("y").alias("b")).where("a <> b").distinct()).select(F.col("node").alias("old"), F.col("label").alias("new"))
    known = ends.select(F.col("a").alias("node"), F.col("x").alias("label")).union(ends.select(F.col("b").alias("node"), F.col("y").alias("label"))).union(labels).distinct()
    return written(known.join(merged, F.col("label") == F.col("old"), "left").select("node", F.coalesce("new", "label").alias("label")))
