"""Global positions 0, 1, 2, ... over a table of any size, and the joins built on them."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from itertools import accumulate
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from flowloom.operators.sizing import lookup_side
from flowloom.sources.staging import stage

# monotonically_increasing_id keeps the partition above bit 33 and the row within it below.
_ROW_BITS = 33


def _ordering(order: Sequence[str]) -> tuple[list[str], list[Column]]:
    """Names and sort columns; a name with a minus before it sorts down."""
    names = [name.removeprefix("-") for name in order]
    return names, [F.col(n).desc() if o != n else F.col(n).asc() for n, o in zip(names, order, strict=True)]


def offset_table(spark: SparkSession, counts: dict[int, int]) -> tuple[DataFrame, int]:
    """(part, begin): the position at which each written partition begins; and the number of rows.

    One row for each partition of a shuffle, however many rows that has.
    """
    firsts = accumulate((counts[part] for part in sorted(counts)), initial=0)
    rows = list(zip(sorted(counts), firsts, strict=False))
    return spark.createDataFrame(rows, "_part int, _begin bigint"), sum(counts.values())


def _is_unique(rows: DataFrame, names: list[str]) -> bool:
    """Eight bytes of each row are shuffled; only rows whose hash repeats are compared themselves."""
    hashed = F.xxhash64(*names)
    again = rows.groupBy(hashed.alias("_hash")).agg(F.count("*").alias("_n")).filter("_n > 1").select("_hash")
    if again.isEmpty():
        return True
    some = rows.select(hashed.alias("_hash"), *names).join(again, "_hash")
    return some.groupBy(*names).agg(F.count("*").alias("_n")).filter("_n > 1").isEmpty()


def numbered(df: DataFrame, *order: str, name: str = "pos") -> tuple[DataFrame, int]:
    """Number the rows from 0 in the given order, which must be unique; also return how many there are.

    `-name` sorts down. `row_number()` over the whole table would sort everything in one task. Here the table is
    range-partitioned by the order, sorted within partitions and staged; all that is brought
    together is one row count per written partition. A unique order also splits a value that holds a
    large share of the rows over several partitions. A repeated order is an error; it is found by counting hashes. (A window over
    the order would need no shuffle, as long as the planner sees that ranges serve it. It does not where a column of the order is constant or a
    floating-point number, and then it would deal the rows by hash and undo the ranges.)
    """
    names, columns = _ordering(order)
    ranged = (
        df.repartitionByRange(*columns)
        .sortWithinPartitions(*columns)
        .withColumn("_seq", F.monotonically_increasing_id())
    )
    staged = stage(ranged, "positions")
    part = F.shiftright("_seq", _ROW_BITS).cast("int")
    if not _is_unique(staged, names):
        raise ValueError(f"the order {', '.join(order)} is not unique")
    offsets, total = offset_table(df.sparkSession, dict(staged.groupBy(part.alias("_part")).agg(F.count("*")).collect()))
    row = F.col("_seq").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    placed = staged.withColumn("_part", part).join(F.broadcast(offsets), "_part")
    return placed.select(*[F.col(f"`{c}`") for c in df.columns], (F.col("_begin") + row).alias(name)), total


def with_position(df: DataFrame, *order: str, name: str = "pos") -> DataFrame:
    """The rows with their position 0, 1, 2, ... in the given order, which must be unique."""
    return numbered(df, *order, name=name)[0]


def positional_zip(
    left: DataFrame,
    left_order: list[str],
    right: DataFrame,
    right_order: list[str],
    name: str = "pos",
) -> DataFrame:
    """Row k of one ordered table beside row k of another; different lengths are an error."""
    left_rows, left_length = numbered(left, *left_order, name=name)
    right_rows, right_length = numbered(right, *right_order, name=name)
    if left_length != right_length:
        raise ValueError(f"cannot zip {left_length} rows with {right_length} rows")
    return left_rows.join(right_rows, name)


# Positions in a block of the join between rows and the groups they are in.
_BLOCK_BITS = 16


def nth_in_group(df: DataFrame, group: Sequence[str], cells: Sequence[Column], tie: Sequence[str], name: str = "nth") -> DataFrame:
    """The place of each row, from 1, among the rows of its group in the order of cells, then of `tie`, which must be unique with them.

    A group may hold a large share of all rows, or all of them, and so may one cell, so no task orders either: rows are numbered over all
    groups by ranges of (group, cells, tie), and the position at which its group begins is taken off. Groups are listed for each
    block of positions that they reach into, so rows find theirs by block and group, and no key of that join has more rows than a
    block. `cells` are columns of whole numbers; rows without one come first.
    """
    names = [f"_cell{k}" for k in range(len(cells))]
    celled = df.withColumns({n: F.coalesce(c.cast("long"), F.lit(-1).cast("long")) for n, c in zip(names, cells, strict=True)})
    rows, _ = numbered(celled, *group, *names, *tie, name="_pos")
    block = F.shiftright("_pos", _BLOCK_BITS)
    begins = rows.groupBy(*group).agg(F.min("_pos").alias("_first"), F.max("_pos").alias("_last"))
    reach = F.sequence(F.shiftright("_first", _BLOCK_BITS), F.shiftright("_last", _BLOCK_BITS))
    keys = [f"_group{k}" for k in range(len(group))]
    listed = begins.select(*[F.col(f"`{g}`").alias(k) for g, k in zip(group, keys, strict=True)], "_first", F.explode(reach).alias("_block"))
    alike = [F.col(f"`{g}`").eqNullSafe(F.col(k)) for g, k in zip(group, keys, strict=True)]
    found = rows.join(lookup_side(stage(listed, "groups")), reduce(and_, [block == F.col("_block"), *alike]))
    return found.select(*[F.col(f"`{c}`") for c in df.columns], (F.col("_pos") - F.col("_first") + 1).alias(name))
