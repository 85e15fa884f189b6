"""Volume over time: learn a profile, lay it over a window, allocate rows, place them, check them."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from flowloom.functions.clock import (
    MINUTES_PER_DAY,
    PROFILE_ANCHOR,
    bound,
    ntz_literal,
    slot_column,
    slot_of,
    time_of_day,
    timestamp_text,
    window_minutes,
)
from flowloom.functions.draws import draw, whole_div
from flowloom.operators.positions import nth_in_group, with_position
from flowloom.operators.sizing import expand_counts
from flowloom.sources.staging import stage

# The lowest accepted density is 30,000 rows in 24 hours; an offset inside a minute
# is a whole number of milliseconds from 0 to 59,999.
LOWEST_DENSITY = 30_000 / MINUTES_PER_DAY
MILLISECONDS_PER_MINUTE = 60_000

# Row id = minute index * 2**40 + ordinal: 10**12 rows in a minute, 15 years of minutes.
_ORDINAL_BITS = 40

_MINUTES_PER_TASK = 100_000


def minute_profile(events: DataFrame, ts: str = "ts", anchor: int = PROFILE_ANCHOR) -> DataFrame:
    """Rows per minute of day, slot 0 at the anchor; all 1,440 slots are present.

    Counts are combined before the shuffle, so each task sends at most 1,440 rows.
    """
    # A missing time gets a slot that no profile has; a slot that can be NULL would be computed twice.
    slot = F.coalesce(slot_column(ts, anchor), F.lit(-1))
    counts = events.groupBy(slot.alias("slot")).agg(F.count("*").alias("_n"))
    slots = events.sparkSession.range(0, MINUTES_PER_DAY, 1, 1).select(F.col("id").cast("int").alias("slot"))
    # At most one row per slot, so the broadcast side is bounded by the day.
    filled = slots.join(F.broadcast(counts), "slot", "left")
    return filled.select("slot", F.coalesce("_n", F.lit(0)).alias("n"))


def profile_window(
    profile: DataFrame, start: str | datetime, end: str | datetime, anchor: int = PROFILE_ANCHOR
) -> DataFrame:
    """The profile laid over [start, end), minute by minute, wrapping at the end of the day."""
    minutes = window_minutes(start, end)
    first = bound(start)
    first_slot = slot_of(first, anchor)
    tasks = -(-minutes // _MINUTES_PER_TASK)
    spine = profile.sparkSession.range(0, minutes, 1, tasks).select(
        F.col("id").cast("int").alias("i"),
        F.timestamp_add("MINUTE", F.col("id").cast("int"), ntz_literal(first)).alias("minute_ts"),
        F.pmod(F.col("id") + first_slot, F.lit(MINUTES_PER_DAY)).cast("int").alias("slot"),
    )
    # Both sides are small; Spark picks the join by their sizes.
    laid = spine.join(profile, "slot", "left")
    return laid.select("i", "minute_ts", "slot", F.coalesce("n", F.lit(0)).alias("n"))


def volume_allocation(window: DataFrame, total: int) -> DataFrame:
    """Whole rows per minute: half-even round of `n * (total / sum(n))`. The total is not kept exactly."""
    whole = window.agg(F.sum("n").cast("double")).scalar()
    share = F.lit(float(total)) / whole
    return window.withColumn("c", F.bround(F.col("n") * share).cast("long"))


def volume_total(allocation: DataFrame, total: int) -> DataFrame:
    """Requested rows, allocated rows and the difference that rounding lost."""
    allocated = F.coalesce(F.sum("c"), F.lit(0))
    requested = F.lit(total).cast("long")
    return allocation.agg(
        requested.alias("requested"), allocated.alias("allocated"), (requested - allocated).alias("lost")
    )


def volume_allocation_exact(window: DataFrame, total: int) -> DataFrame:
    """Whole rows per minute that add up to the total: largest remainders get the rows left over.

    Quotients and remainders are whole numbers, so equal remainders tie exactly and go to the
    earlier minute.
    """
    weight = F.lit(total).cast(DecimalType(18, 0)) * F.col("n").cast(DecimalType(19, 0))
    whole = window.agg(F.sum("n")).scalar().cast(DecimalType(19, 0))
    parts = window.withColumn("_base", whole_div(weight, whole)).withColumn("_rest", weight % whole)
    ranked = with_position(parts, "-_rest", "i", name="_rank")
    left_over = F.lit(total) - ranked.agg(F.sum("_base")).scalar()
    extra = F.when(F.col("_rank") < left_over, 1).otherwise(0)
    return ranked.select(*window.columns, (F.col("_base") + extra).alias("c"))


def row_expansion(allocation: DataFrame, expected_rows: int | None = None) -> DataFrame:
    """One row per allocated unit: id, minute index i, ordinal k (from 1) and minute."""
    units = expand_counts(allocation.select("i", "minute_ts", "c"), "c", "k", ["i"], expected_rows)
    identity = F.col("i").cast("long") * F.lit(1 << _ORDINAL_BITS) + F.col("k")
    return units.select(identity.alias("id"), "i", "k", "minute_ts")


def jittered(minute: str = "minute_ts", key: str = "id") -> Column:
    """Timestamp of a row: its minute plus a drawn number of milliseconds."""
    return F.timestamp_add("MILLISECOND", draw(MILLISECONDS_PER_MINUTE, "offset", key).cast("int"), minute)


def minute_jitter(rows: DataFrame) -> DataFrame:
    """Timestamp inside the minute, its text form and the ordinal of the row within its minute by time.

    A minute may hold a large share of all rows; no task orders a whole minute.
    """
    timed = rows.select("id", "i", jittered().alias("ts"))
    placed = nth_in_group(timed, ["i"], [], ["ts", "id"])
    return placed.select("id", "i", "ts", F.col("nth").cast("long").alias("nth"), timestamp_text("ts").alias("ts_text"))


def order_in_day(events: DataFrame, ts: str, tie: str) -> DataFrame:
    """The rows with their day and their place in it, from 1, by time and then by the tie column, which must be unique.

    Rows without a time have no day and are ordered among themselves by the tie column. No task holds a whole day, nor all rows of one
    time or without one, since the tie column is part of the ranges.
    """
    return nth_in_group(events.withColumn("day", F.to_date(ts)), ["day"], [], [ts, tie], "nth")


def minute_counts(events: DataFrame, start: str | datetime, end: str | datetime, ts: str = "ts") -> DataFrame:
    """Rows per minute of [start, end): (i, c) for every minute, 0 where there are none."""
    minutes = window_minutes(start, end)
    since = whole_div(F.timestamp_diff("MICROSECOND", ntz_literal(bound(start)), ts), 60_000_000)
    inside = (F.col(ts) >= ntz_literal(bound(start))) & (F.col(ts) < ntz_literal(bound(end)))
    counts = events.filter(inside).groupBy(since.cast("int").alias("i")).agg(F.count("*").alias("_n"))
    tasks = -(-minutes // _MINUTES_PER_TASK)
    spine = events.sparkSession.range(0, minutes, 1, tasks).select(F.col("id").cast("int").alias("i"))
    return spine.join(counts, "i", "left").select("i", F.coalesce("_n", F.lit(0)).alias("c"))


def expected_vs_actual(window: DataFrame, counted: DataFrame) -> DataFrame:
    """Per minute: profile value, expected share of all rows, actual rows, expected rows and the difference.

    `counted` has the actual rows of each minute: those of an allocation, or `minute_counts` of an event table.
    """
    actual = counted.select("i", "c")
    whole = window.agg(F.sum("n").cast("double")).scalar()
    total = actual.agg(F.sum("c").cast("double")).scalar()
    both = window.join(actual, "i")
    expected = F.col("n") * (total / whole)
    return both.select(
        "i",
        "minute_ts",
        "n",
        (F.col("n") / whole).alias("expected_share"),
        F.col("c").alias("actual_rows"),
        expected.alias("expected_rows"),
        (F.col("c") - expected).alias("difference"),
    )


def tick_rollup(events: DataFrame, ts: str = "ts", every: str = "5 minutes") -> DataFrame:
    """Rows per tick from the first to the last tick that holds rows; empty ticks are present as 0.

    Rows without a time lie in no tick. The counts are staged: they are needed for the ends of the range and for the ticks, and Spark
    would scan the events for each.
    """
    tick = F.window(ts, every).getField("start").alias("tick")
    counts = stage(events.groupBy(tick).agg(F.count("*").alias("_n")), "ticks")
    step = F.expr(f"INTERVAL {every}")
    ends = counts.agg(F.min("tick").alias("_first"), F.max("tick").alias("_last"))
    steps = whole_div(
        F.timestamp_diff("MICROSECOND", "_first", "_last"),
        F.timestamp_diff("MICROSECOND", "_first", F.col("_first") + step),
    )
    span = ends.select("_first", (steps + 1).alias("_ticks"))
    number = span.first()["_ticks"] or 0
    units = expand_counts(span, "_ticks", "_k", ["_first"], number)
    ticks = units.select((F.col("_first") + step * (F.col("_k") - 1)).alias("tick"))
    filled = ticks.join(counts, "tick", "left")
    return filled.select("tick", time_of_day("tick").alias("label"), F.coalesce("_n", F.lit(0)).alias("n"))


def density_check(
    df: DataFrame,
    ts: str = "ts",
    min_per_minute: float | None = LOWEST_DENSITY,
    minutes: int = MINUTES_PER_DAY,
    strict: bool = False,
) -> DataFrame:
    """Rows per minute of each window against a floor; a window passes when it reaches the floor.

    Without a floor the mean over all windows is taken. Rows without a time lie in no window. Windows without rows between the first and the last one are tested too. With `strict` a window
    that fails raises an error when the result is computed.
    """
    counts = tick_rollup(df, ts, f"{minutes} minutes")
    per_minute = F.col("n") / F.lit(float(minutes))
    mean = counts.agg(F.avg("n") / F.lit(float(minutes))).scalar() if min_per_minute is None else F.lit(float(min_per_minute))
    passes = per_minute >= mean
    if strict:
        text = F.concat(F.lit("too few rows in the window from "), F.col("tick").cast("string"))
        passes = F.when(passes, F.lit(True)).otherwise(F.raise_error(text).cast("boolean"))
    return counts.select(
        F.col("tick").alias("window_start"),
        "n",
        per_minute.alias("per_minute"),
        mean.alias("min_per_minute"),
        passes.alias("passes"),
    )
