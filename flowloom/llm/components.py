"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowloom.llm.heavy import heavy_joined
from flowloom.sources.staging import stage


def _smallest(links: DataFrame) -> DataFrame:
    """(node, label): the smallest of a node and its neighbours, followed twice from there."""
    both = links.union(links.select("b", "a"))
    step = both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("label"))
    step = stage(step, "labels")
    for _ in range(2):
        there = step.select(F.col("node").alias("label"), F.col("label").alias("further"))
        step = stage(heavy_joined(step, there, ["label"]).select("node", F.col("further").alias("label")), "labels")
    return step


def components(links: DataFrame) -> DataFrame:
    """From links (a, b): (node, label) for every linked node, the label being the smallest node of its component.

    Each round replaces nodes by labels and goes on with the links between different labels, so the table shrinks
    until none is left. Links and labels stay in tables; the driver only sees whether one is empty. A node in many links
    is one row after pre-aggregation; empty links give an empty result.
    """
    links = stage(links.filter("a <> b").select("a", "b").distinct(), "links")
    labels = None
    while True:
        hop = _smallest(links)
        if labels is None:
            labels = hop
        else:
            further = hop.select(F.col("node").alias("label"), F.col("label").alias("next"))
            moved = heavy_joined(labels, further, ["label"], "left")
            labels = stage(moved.select("node", F.coalesce("next", "label").alias("label")), "labels")
        one = hop.select(F.col("node").alias("a"), F.col("label").alias("la"))
        two = hop.select(F.col("node").alias("b"), F.col("label").alias("lb"))
        ends = stage(heavy_joined(links, one, ["a"]), "ends")
        between = heavy_joined(ends, two, ["b"]).filter("la <> lb")
        links = stage(between.select(F.col("la").alias("a"), F.col("lb").alias("b")).distinct(), "links")
        if links.isEmpty():
            return labels
