"""Connected components of an edge table, as joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import checkpointed


def components(edges: DataFrame) -> DataFrame:
    """(node, label) for every node of the edges (a, b); label is the least node reachable.

    Each round takes the least label of the neighbours and then the label's own label, so that
    the rounds grow with the logarithm of a chain's length. Labels are checkpointed each round; nothing
    but the number of changes reaches the driver.
    """
    both = edges.select("a", "b").unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()
    both = checkpointed(both)
    labels = checkpointed(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("near")).select("node", F.least("node", "near").alias("label")))
    while True:
        near = both.join(labels.select(F.col("node").alias("b"), "label"), "b").groupBy(F.col("a").alias("node")).agg(F.min("label").alias("near"))
        taken = labels.join(near, "node").select("node", F.col("label").alias("old"), F.least("label", "near").alias("to"))
        # the label's own label, as it was: never larger than the label
        jumped = taken.join(labels.select(F.col("node").alias("to"), F.col("label").alias("far")), "to")
        after = checkpointed(jumped.select("node", "old", F.least("to", "far").alias("label")))
        changed = after.filter(F.col("label") != F.col("old")).limit(1).count()
        labels = after.select("node", "label")
        if not changed:
            return labels
