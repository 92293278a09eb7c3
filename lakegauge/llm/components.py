"""Connected components of a table of links, in Spark joins with the lineage cut each round."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .workspace import Workspace


def components(links: DataFrame, work: Workspace, name: str) -> DataFrame:
    """(node, label) for every node of links (a, b): label is the smallest node that it reaches.

    Every round takes the least label of the neighbours and then the label of that label, until
    none changes. The driver sees one count a round. Both sides of each join are read from
    tables, so a node with very many links is split by Spark.
    """
    both = work.write(links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), f"{name}-both")
    labels = work.write(both.select(F.col("a").alias("node")).distinct().withColumn("label", F.col("node")), f"{name}-0")
    i = 0
    while True:
        i += 1
        least = both.join(labels, both.b == labels.node).groupBy("a").agg(F.min("label").alias("least"))
        step = labels.join(least, labels.node == least.a, "left").select("node", F.least("label", "least").alias("label"), F.col("label").alias("before"))
        step = work.write(step, f"{name}-{i}-step")
        jump = step.select(F.col("node").alias("at"), F.col("label").alias("further"))
        moved = step.join(jump, step.label == jump["at"], "left").select("node", F.least("label", "further").alias("label"), "before")
        found = work.write(moved, f"{name}-{i}")
        changed = found.where("label <> before").limit(1).count()
        labels = found.select("node", "label")
        if not changed:
            return labels
