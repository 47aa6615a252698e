"""Connected components of an edge table by contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spanloom.llm.stages import written


def _rooted(parents: DataFrame) -> DataFrame:
    """(node, label) with each label replaced by the label of its label, until
    nothing changes; labels are never above their node, so there is no cycle."""
    while True:
        above = parents.select(F.col("node").alias("label"), F.col("label").alias("top"))
        new = written(parents.join(above, "label", "left").select("node", F.col("label").alias("old"), F.coalesce("top", "label").alias("label")))
        parents = new.select("node", "label")
        if new.filter("old <> label").isEmpty():
            return parents


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges(a, b)``; a component is named
    by its smallest node.

    Each round every node takes the smallest node around it, these labels are
    followed to their roots, and the edges are drawn again between the roots:
    loops and repeated edges go, so every round has fewer rows than the one
    before. Rounds are written down, so plans stay short and a lost executor
    costs one of them. At the end the labels of the rounds are put together, the
    last (smallest) first. Self-loops only name their node; null ends are ignored.
    """
    given = edges.filter(F.col("a").isNotNull() & F.col("b").isNotNull())
    loops = given.filter("a = b").select(F.col("a").alias("node"))
    live = written(given.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    rounds = []
    while not live.isEmpty():
        around = live.select(F.col("b").alias("node"), F.col("a").alias("label")).unionByName(live.select(F.col("a").alias("node"), F.col("a").alias("label")))
        rounds.append(_rooted(written(around.groupBy("node").agg(F.min("label").alias("label")))))
        low = rounds[-1].select(F.col("node").alias("a"), F.col("label").alias("x"))
        high = rounds[-1].select(F.col("node").alias("b"), F.col("label").alias("y"))
        drawn = live.join(low, "a").join(high, "b").filter("x <> y").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))
        live = written(drawn.distinct())
    labels = None
    for found in reversed(rounds):
        if labels is not None:
            later = labels.select(F.col("node").alias("label"), F.col("label").alias("last"))
            found = found.join(later, "label", "left").select("node", F.coalesce("last", "label").alias("label"))
        labels = found
    alone = loops.distinct().withColumn("label", F.col("node"))
    if labels is not None:
        alone = alone.join(labels.select("node"), "node", "left_anti").unionByName(labels)
    return alone.select("node", F.col("label").alias("component"))
