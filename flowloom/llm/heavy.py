"""Joins with a lookup table on keys of which a few may hold a large share of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowloom.llm.bloom import fresh_names

#: A key is heavy when it holds more than one in so many rows, so there are fewer heavy keys than this.
PARTS = 1000


def heavy_joined(rows: DataFrame, lookup: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """`rows` joined (inner or left) with a lookup table that has each key once. `rows` should be a staged table: it is read several times.

    Rows of heavy keys stay where they are and meet the broadcast entries of these keys, fewer than `PARTS` whatever the tables
    hold; the others are shuffled, and none of their keys has more than one in `PARTS` of all rows. Keys are not null.
    """
    total = rows.count()
    count = fresh_names(rows, "rows_of_key")[0]
    heavy = rows.groupBy(*keys).agg(F.count("*").alias(count)).filter(F.col(count) * PARTS > total).select(*keys)
    # Fewer than `PARTS` keys, which a broadcast brings to the driver anyway; a table of them would be a job and files for each join.
    found = heavy.toArrow()
    if not found.num_rows:
        return rows.join(lookup, keys, how)
    heavy = F.broadcast(rows.sparkSession.createDataFrame(found, heavy.schema))
    few = F.broadcast(lookup.join(heavy, keys, "left_semi"))
    hot = rows if how == "inner" else rows.join(heavy, keys, "left_semi")
    light = rows.join(heavy, keys, "left_anti").join(lookup, keys, how)
    return light.unionByName(hot.join(few, keys, how))
