"""Size check in front of a broadcast, and expansion of counts into rows."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DatetimeType, NumericType

from flowloom.functions.draws import whole_div

# Largest lookup table that is broadcast, unless the session sets another size.
BROADCAST_SETTING = "flowloom.broadcastBytes"
BROADCAST_BYTES = 64 * 1024 * 1024

# Rows made from one array; three levels of it reach 5 * 10**11 rows per input row.
_STEP = 8192
ROWS_PER_TASK = 4_000_000
LEAST_ROWS_PER_TASK = 50_000


def table_bytes(df: DataFrame, rows: int | None = None) -> int:
    """Size of the rows in memory: 8 bytes for a number or date, the measured length for any other value.

    16 bytes per row and per measured value come on top. `rows`, if the caller knows the number or a
    bound, saves the pass over a table in which nothing has to be measured.
    """
    measured = [f.name for f in df.schema if not isinstance(f.dataType, (NumericType, BooleanType, DatetimeType))]
    width = 16 + 8 * len(df.columns) + 16 * len(measured)
    if rows is not None and not measured:
        return rows * width
    lengths = [F.octet_length(F.col(f"`{name}`").cast("string")).cast("long") for name in measured]
    counted, *total = df.agg(F.count("*"), *[F.coalesce(F.sum(n), F.lit(0)) for n in lengths]).first()
    return counted * width + sum(total)


def lookup_side(df: DataFrame, rows: int | None = None) -> DataFrame:
    """Mark a lookup table for broadcast if its size allows it.

    A larger table goes unmarked and is joined by shuffle; it is used with keys that are uniform hashes or positions, so no
    partition of that shuffle is hot. Nothing is marked where the session has switched automatic broadcasts off. Pass a staged
    table, or the number of rows: a table that has to be measured is read twice.
    """
    if df.sparkSession.conf.get("spark.sql.autoBroadcastJoinThreshold").startswith("-"):
        return df
    limit = int(df.sparkSession.conf.get(BROADCAST_SETTING, str(BROADCAST_BYTES)))
    return F.broadcast(df) if table_bytes(df, rows) <= limit else df


def expand_counts(df: DataFrame, count: str, ordinal: str, keys: list[str], expected_rows: int | None = None) -> DataFrame:
    """One row per unit of `count`, numbered from 1 in `ordinal`; counts of 0 give no row.

    A count is cut into pieces of at most 8,192 and the pieces are spread over the tasks before
    rows are made of them, so one huge count is shared by many tasks and no array is long. Pieces are
    spread in the order of `keys`, so a task makes neighbouring rows. The number of tasks follows
    `expected_rows`, because the few bytes shuffled here say nothing about the rows to come.
    """
    spark = df.sparkSession
    if expected_rows is None:
        tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    else:
        useful = min(spark.sparkContext.defaultParallelism, expected_rows // LEAST_ROWS_PER_TASK)
        tasks = max(1, useful, math.ceil(expected_rows / ROWS_PER_TASK))
    last = F.col(count) - 1
    blocks = df.filter(F.col(count) > 0).withColumn(
        "_block", F.explode(F.sequence(F.lit(0).cast("long"), whole_div(last, _STEP * _STEP)))
    )
    first_piece = F.col("_block") * _STEP
    pieces = blocks.withColumn(
        "_piece",
        F.explode(F.sequence(first_piece, F.least(first_piece + (_STEP - 1), whole_div(last, _STEP)))),
    ).drop("_block")
    spread = pieces.repartitionByRange(tasks, *keys, "_piece") if tasks > 1 else pieces
    first = F.col("_piece") * _STEP + 1
    units = F.explode(F.sequence(first, F.least(first + (_STEP - 1), F.col(count).cast("long"))))
    return spread.withColumn(ordinal, units).drop("_piece")
