"""Overlap joins of two tables of intervals."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowloom.functions.draws import whole_div
from flowloom.operators.positions import numbered
from flowloom.operators.sizing import lookup_side
from flowloom.sources.staging import stage
from flowloom.sources.workers import find_package

#: Bins of a level are so many times as wide as those of the level below; an interval lies in at most one more bin of its level.
WIDER = 16
#: Pairs of rows in a bin that one task compares; bins with more are cut.
PAIRS = 1 << 22
#: A block of points has 2**17 rows; windows that one task counts in a block.
BLOCK_BITS, LOT = 17, 1 << 18


def _level(length: Column, width: int, levels: int) -> Column:
    """The lowest level whose bins are as wide as the interval is at least long divided by `WIDER`."""
    found = F.lit(levels - 1)
    for k in range(levels - 2, -1, -1):
        found = F.when(length <= F.lit(width * WIDER ** (k + 1)).cast("long"), k).otherwise(found)
    return found


def _levelled(rows: DataFrame, start: str, end: str, width: int, levels: int, side: str) -> DataFrame:
    """The rows as a struct with their first and last point and their level. Empty intervals are left out."""
    first, last = F.col(f"`{start}`").cast("long"), F.col(f"`{end}`").cast("long") - 1
    row = F.struct(*[F.col(f"`{c}`") for c in rows.columns]).alias(f"_{side}")
    own = _level(last - first + 1, width, levels).alias(f"_{side}_level")
    known = rows.select(row, first.alias(f"_{side}_first"), last.alias(f"_{side}_last"), own)
    return known.filter(F.col(f"_{side}_first") <= F.col(f"_{side}_last"))


def _binned(known: DataFrame, width: int, side: str, others: list[int]) -> DataFrame:
    """A row for each bin that an interval touches, at its own level and at those above on which the other side has intervals."""
    own = F.col(f"_{side}_level")

    def bins(level: Column) -> Column:
        wide = F.pow(F.lit(WIDER), level).cast("long") * width
        touched = F.sequence(_floor(F.col(f"_{side}_first"), wide), _floor(F.col(f"_{side}_last"), wide))
        return F.transform(touched, lambda b: F.struct(level.alias("_bin_level"), b.alias("_bin")))

    above = F.filter(F.array(*map(F.lit, others)), lambda k: k > own)
    wanted = F.when(own >= min(others), F.concat(F.array(own), above)).otherwise(above)
    return known.select("*", F.inline(F.flatten(F.transform(wanted, bins))))


def _floor(value: Column, by: Column) -> Column:
    """Whole-number quotient, rounded down also below 0."""
    return whole_div(value - F.pmod(value, by), by)


def overlap_join(
    left: DataFrame, left_ends: tuple[str, str], right: DataFrame, right_ends: tuple[str, str], width: int | None = None,
    levels: int | None = None,
) -> DataFrame:
    """All pairs (struct `left`, struct `right`) of rows whose half-open intervals [start, end) of whole numbers overlap, each once.

    An interval is listed in the bins it touches, at the level of its length and at the coarser ones that the other side uses: at most
    17 bins of its own level and two of each other, if there are `levels` enough, by default as many as the longest one needs. A pair meets at the level of its longer
    interval, in the bin where the later of both begins, and nowhere else. So a join on (level, bin) finds each pair
    once, and neither long intervals nor short ones meet rows they have nothing to do with. Bins with many pairs are cut: rows of
    the larger side are dealt to slices, those of the smaller one are repeated in each. `width` is that of the finest bins, by
    default a sixteenth of the mean length on the side with the shorter intervals. Intervals with a null end, and empty ones, overlap nothing.
    """
    spans = []
    for rows, (start, end) in ((left, left_ends), (right, right_ends)):
        span = F.col(f"`{end}`").cast("long") - F.col(f"`{start}`").cast("long")
        spans.append(rows.filter(span > 0).agg(F.avg(span), F.max(span)).first())
    if width is None:
        width = max(1, int(min(mean or 1 for mean, _ in spans) / WIDER))
    if levels is None:
        longest, levels = max(most or 1 for _, most in spans), 1
        while width * WIDER**levels < longest:
            levels += 1
    ours = stage(_levelled(left, *left_ends, width, levels, "left"), "left")
    theirs = stage(_levelled(right, *right_ends, width, levels, "right"), "right")
    # At most as many values as there are levels.
    used = [[r[0] for r in rows.select(f"_{side}_level").distinct().collect()] for rows, side in ((ours, "left"), (theirs, "right"))]
    nothing = [levels]
    ours, theirs = _binned(ours, width, "left", used[1] or nothing), _binned(theirs, width, "right", used[0] or nothing)
    bins = ["_bin_level", "_bin"]
    counts = ours.groupBy(*bins).agg(F.count("*").alias("_l")).join(theirs.groupBy(*bins).agg(F.count("*").alias("_r")), bins)
    hot = counts.filter(F.col("_l").cast("double") * F.col("_r") > PAIRS)
    cut = F.ceil(F.col("_l").cast("double") * F.col("_r") / PAIRS).cast("int")
    hot = stage(hot.select(*bins, F.least(cut, F.greatest("_l", "_r").cast("int")).alias("_cuts"), (F.col("_l") >= F.col("_r")).alias("_ours")), "hot")
    table = lookup_side(hot)

    def dealt(rows: DataFrame, side: str) -> DataFrame:
        known = rows.join(table, bins, "left")
        mine = F.col("_ours") if side == "left" else ~F.col("_ours")
        lot = F.pmod(F.xxhash64(F.to_json(f"_{side}")), F.col("_cuts")).cast("int")
        lots = F.when(F.col("_cuts").isNull(), F.array(F.lit(0))).when(mine, F.array(lot)).otherwise(F.sequence(F.lit(0), F.col("_cuts") - 1))
        return known.withColumn("_lot", F.explode(lots)).drop("_cuts", "_ours")

    met = dealt(ours, "left").join(dealt(theirs, "right"), [*bins, "_lot"])
    later, level = F.greatest("_left_first", "_right_first"), F.greatest("_left_level", "_right_level")
    wide = F.pow(F.lit(WIDER), level).cast("long") * width
    overlap = (F.col("_left_first") <= F.col("_right_last")) & (F.col("_right_first") <= F.col("_left_last"))
    once = (F.col("_bin_level") == level) & (F.col("_bin") == _floor(later, wide))
    return met.filter(overlap & once).select(F.col("_left").alias("left"), F.col("_right").alias("right"))


def overlap_counts(points: DataFrame, at: str, key: str, windows: DataFrame, ends: tuple[str, str], by: str) -> DataFrame:
    """(by, n, keys): the points in the half-open windows [start, end) of each value of `by`, and the distinct keys among them.

    These are the numbers of rows and of distinct non-null keys that grouping the pairs of `overlap_join` by `by` gives, without a row for
    each pair. Points are numbered by time and cut into blocks of bounded size; `overlap_join` finds the blocks that a window
    meets, all but two of them from end to end. A key counts at its first point in the window: where the point of
    the key before it lies before the window. So each block adds up rows, and points whose predecessor lies before a bound, on its own.
    Points without a time and windows as `overlap_join` leaves them out; values of `by` without points too.
    Where windows under one value of `by` differ, a key may lie in several of them, and their pairs are grouped as they are.
    """
    find_package(points.sparkSession)
    known = windows.select(F.col(f"`{by}`").alias("_by"), *[F.col(f"`{e}`").cast("long").alias(n) for e, n in zip(ends, ("_a", "_b"), strict=True)])
    least = [f(c).alias(f"{name}{c}") for c in ("_a", "_b") for name, f in (("_min", F.min), ("_max", F.max))]
    own = known.filter("_a < _b").groupBy("_by").agg(*least, F.count("*").alias("_times"))
    own = stage(own.withColumn("_id", F.monotonically_increasing_id()), "windows")
    alike = F.expr("_min_a = _max_a and _min_b = _max_b")
    single = own.filter(alike).select("_id", F.col("_min_a").alias("_a"), F.col("_min_b").alias("_b"))
    blocks = _blocks(points.select(F.col(f"`{at}`").cast("long").alias("_at"), F.col(f"`{key}`").alias("_key")))
    bounds = stage(blocks.groupBy("_block").agg(F.min("_at").alias("_first"), (F.max("_at") + 1).alias("_behind")), "blocks")
    met = overlap_join(bounds, ("_first", "_behind"), single, ("_a", "_b")).select("left._block", "right._id", "right._a", "right._b")
    met = stage(met, "met")
    # One row for each block. Points of a block with many windows are repeated for lots of windows.
    lots = met.groupBy("_block").agg(F.ceil(F.count("*") / LOT).cast("int").alias("_lots"))
    lots = F.broadcast(stage(lots, "lots"))
    dealt = blocks.join(lots, "_block").withColumn("_lot", F.explode(F.sequence(F.lit(0), F.col("_lots") - 1))).drop("_lots")
    asked = met.join(lots, "_block").withColumn("_lot", F.pmod(F.xxhash64("_id"), F.col("_lots")).cast("int")).drop("_lots")
    both = dealt.groupBy("_block", "_lot").cogroup(asked.groupBy("_block", "_lot"))
    counts = both.applyInArrow(_counted, "_id long, n long, keys long").groupBy("_id").agg(F.sum("n").alias("n"), F.sum("keys").alias("keys"))
    result = counts.filter("n > 0").join(own, "_id").select(F.col("_by").alias(by), (F.col("n") * F.col("_times")).alias("n"), "keys")
    unlike = own.filter(~alike).select(F.col("_by").alias("_wanted"))
    if unlike.isEmpty():
        return result
    some = known.join(unlike, F.col("_by").eqNullSafe(F.col("_wanted")), "left_semi")
    moments = points.select(F.col(f"`{at}`").cast("long").alias("_at"), (F.col(f"`{at}`").cast("long") + 1).alias("_behind"), F.col(f"`{key}`").alias("_key"))
    pairs = overlap_join(moments, ("_at", "_behind"), some, ("_a", "_b")).groupBy(F.col("right._by").alias(by))
    return result.union(pairs.agg(F.count("*").alias("n"), F.count_distinct("left._key").alias("keys")))


def _blocks(points: DataFrame) -> DataFrame:
    """(_block, _at, _n, _keyed, _before): points with a time, equal ones as one with their number, and the time of the key's point before."""
    once = points.filter("_at is not null").groupBy("_at", "_key").agg(F.count("*").alias("_n"))
    placed = numbered(once, "_at", "_key", name="_pos")[0].withColumn("_block", F.shiftright("_pos", BLOCK_BITS)).drop("_pos")
    keyed = placed.filter("_key is not null")
    # A key has one row for each block here, and one block's rows there, so a frequent key is no large group.
    last = keyed.groupBy("_key", "_block").agg(F.max("_at").alias("_last"))
    earlier = last.select("_key", "_block", F.lag("_last").over(Window.partitionBy("_key").orderBy("_block")).alias("_earlier"))
    inside = F.lag("_at").over(Window.partitionBy("_key", "_block").orderBy("_at"))
    behind = keyed.withColumn("_inside", inside).join(earlier, ["_key", "_block"])
    known = behind.select("_block", "_at", "_n", F.lit(True).alias("_keyed"), F.coalesce("_inside", "_earlier").alias("_before"))
    others = placed.filter("_key is null").select("_block", "_at", "_n", F.lit(False), F.lit(None).cast("long"))
    return stage(known.union(others), "points")


def _counted(points: pa.Table, windows: pa.Table) -> pa.Table:
    """(_id, n, keys) of the windows in a block of points."""
    at = points["_at"].to_numpy()
    order = np.argsort(at, kind="stable")
    rows = np.concatenate([[0], np.cumsum(points["_n"].to_numpy()[order])])
    before, keyed = points["_before"].combine_chunks(), points["_keyed"].to_numpy()
    missing = np.asarray(before.is_null())
    times = before.fill_null(0).to_numpy(zero_copy_only=False)
    known = np.unique(times[~missing])
    # 0: the key's first point; behind all: no key.
    rank = np.where(missing, 0, np.searchsorted(known, times) + 1)
    rank = np.where(keyed, rank, len(known) + 1)[order]
    start, end = windows["_a"].to_numpy(), windows["_b"].to_numpy()
    low, high = np.searchsorted(at[order], start), np.searchsorted(at[order], end)
    keys = _count_below(rank, low, high, np.searchsorted(known, start) + 1)
    columns = [windows["_id"].combine_chunks(), pa.array(rows[high] - rows[low], pa.int64()), pa.array(keys, pa.int64())]
    return pa.table(columns, names=["_id", "n", "keys"])


def _count_below(values: np.ndarray, low: np.ndarray, high: np.ndarray, bound: np.ndarray) -> np.ndarray:
    """For each range [low, high) the number of values below its bound, bit by bit: in each step values with a 0 go before those with a 1."""
    found = np.zeros(len(low), np.int64)
    for bit in range(int(max(values.max(initial=0), bound.max(initial=0))).bit_length() - 1, -1, -1):
        ones = (values >> bit & 1).astype(bool)
        zeros = np.concatenate([[0], np.cumsum(~ones)])
        left, right = zeros[low], zeros[high]
        wanted = (bound >> bit & 1).astype(bool)
        found += np.where(wanted, right - left, 0)
        low, high = np.where(wanted, zeros[-1] + low - left, left), np.where(wanted, zeros[-1] + high - right, right)
        values = np.concatenate([values[~ones], values[ones]])
    return found
