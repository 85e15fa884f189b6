"""Distinct neighbours of nodes in sliding windows of time."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Registers of a sketch: 2**12, so an estimate is off by some 1.04 / 64 = 1.6 % (one standard deviation).
REGISTER_BITS = 12
#: Rows of a partition, so that what one task holds does not grow with the table.
ROWS = 1 << 18


def _windows(tick: Column, ticks: int) -> Column:
    """The windows that a tick lies in, each named by its last tick."""
    return F.explode(F.sequence(tick, tick + ticks - 1))


def window_neighbours(edges: DataFrame, node: str, neighbour: str, tick: Column, ticks: int) -> DataFrame:
    """(node, window, n): the number of distinct neighbours in each window of so many ticks, named by its last; windows without any are left out.

    Edges are counted and dealt by node and neighbour to as many partitions as their number takes. There a neighbour is made one
    row per node and tick, and one that is seen in several ticks of a window is one again, without a further shuffle: a task holds
    each tick of a pair once, however often it comes. Only counts by task, node and window are shuffled after that. Null
    nodes, neighbours and ticks are left out.
    """
    rows = edges.select(F.col(f"`{node}`").alias("node"), F.col(f"`{neighbour}`").alias("_other"), tick.cast("long").alias("_tick"))
    least = int(edges.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    seen = rows.na.drop().repartition(max(least, -(-edges.count() // ROWS)), "node", "_other").distinct()
    spread = seen.select("node", "_other", _windows(F.col("_tick"), ticks).alias("window")).distinct()
    return spread.groupBy("node", "window").agg(F.count("*").alias("n"))


def window_neighbours_estimated(
    edges: DataFrame, node: str, neighbour: str, tick: Column, ticks: int, bits: int = REGISTER_BITS
) -> DataFrame:
    """The same with HyperLogLog sketches: neighbours become registers by node and tick, and these are merged over windows.

    What is shuffled is one sketch of bounded size for each task, node and tick, so a hot node costs no more than others.
    """
    rows = edges.select(F.col(f"`{node}`").alias("node"), F.col(f"`{neighbour}`").alias("_other"), tick.cast("long").alias("_tick"))
    sketches = rows.na.drop().groupBy("node", "_tick").agg(F.hll_sketch_agg("_other", F.lit(bits)).alias("_sketch"))
    spread = sketches.select("node", "_sketch", _windows(F.col("_tick"), ticks).alias("window"))
    merged = spread.groupBy("node", "window").agg(F.hll_union_agg("_sketch").alias("_sketch"))
    return merged.select("node", "window", F.hll_sketch_estimate("_sketch").alias("n"))
