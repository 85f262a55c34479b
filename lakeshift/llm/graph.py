"""Connected components of an edge table, as DataFrame joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeshift.llm.common import stored


def components(edges: DataFrame) -> DataFrame:
    """(node, comp) for every node of ``edges`` (a, b): ``comp`` is the smallest node reachable.

    First every node is merged into the smallest of its neighbours and itself.
    What the rounds join are the edges between merged nodes, each once: few
    where many nodes share neighbours, never more than there were.

    Each round takes the smallest label among the neighbours and then the label
    of that label, so the rounds grow with the logarithm of the longest path.
    The table of a round is stored; only the count of changes reaches the driver.
    """
    both = stored(
        edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "edges"
    )
    merged = stored(_least_neighbours(both).withColumnRenamed("comp", "into"), "merged")
    half = both.join(merged, F.col("a") == F.col("node")).select(F.col("into").alias("a"), "b").distinct()
    between = half.join(merged, F.col("b") == F.col("node")).select("a", F.col("into").alias("b")).filter("a <> b").distinct()
    labels = _labels(stored(between, "merged-edges")).withColumnRenamed("node", "of")
    # The smallest node of all is merged into itself, so the smallest label is still its.
    return stored(merged.join(labels, F.col("into") == F.col("of"), "left").select("node", F.coalesce("comp", "into").alias("comp")), "labels")


def _least_neighbours(both: DataFrame) -> DataFrame:
    """(node, comp): the smallest of each node and its neighbours; ``both`` has every edge both ways."""
    return both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m")).select("node", F.least("node", "m").alias("comp"))


def _labels(both: DataFrame) -> DataFrame:
    """(node, comp) for every node of ``both``, which has every edge both ways."""
    labels = stored(_least_neighbours(both), "labels")
    while True:
        near = both.join(labels, F.col("b") == F.col("node")).groupBy("a").agg(F.min("comp").alias("near"))
        lower = labels.join(near, F.col("node") == F.col("a")).select("node", F.col("comp").alias("old"), F.least("comp", "near").alias("comp"))
        jump = labels.select(F.col("node").alias("via"), F.col("comp").alias("beyond"))
        new = stored(
            lower.join(jump, F.col("comp") == F.col("via"), "left").select("node", "old", F.least("comp", "beyond").alias("comp")),
            "labels",
        )
        labels, changed = new.select("node", "comp"), new.filter("comp <> old").limit(1).count()
        if not changed:
            return labels
