"""Flows as a directed graph."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def flow_edges(flows: DataFrame, src: str = "source_IP", dst: str = "destination_IP") -> DataFrame:
    """Distinct directed edges with the number of flows on each; counted before the shuffle."""
    return flows.groupBy(F.col(src).alias("src"), F.col(dst).alias("dst")).agg(F.count("*").alias("n"))


def flow_nodes(flows: DataFrame, src: str = "source_IP", dst: str = "destination_IP", distinct: bool = False) -> DataFrame:
    """Every address on either side once, with the number of distinct edges that leave and enter it.

    Edges are made distinct first, then each gives one row per end; flows are read once, and a node with
    very many edges is summed up before the shuffle. `distinct` says that the rows are distinct edges already.
    """
    edges = flows.select(F.col(src).alias("src"), F.col(dst).alias("dst"))
    edges = edges if distinct else edges.distinct()

    def end(node: str, leaves: int):
        return F.struct(F.col(node).alias("node"), F.lit(leaves).alias("leaves"), F.lit(1 - leaves).alias("enters"))

    ends = edges.select(F.inline(F.array(end("src", 1), end("dst", 0))))
    return ends.groupBy("node").agg(F.sum("leaves").alias("out_degree"), F.sum("enters").alias("in_degree"))
