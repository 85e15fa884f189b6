"""How well a released table keeps the distributions of the original."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BINS = 200
#: Chi-square terms are added up in whole millionths, so the sum does not depend on its order.
_SCALE = 1_000_000


def _bin(value: Column, low: Column, high: Column, bins: int) -> Column:
    """Equal-width bins 0 ... bins - 1 from the lowest to the highest value, -1 for no value (null or not a number)."""
    place = F.floor((value - low) / ((high - low) / bins)).cast("long")
    inside = F.when(high > low, F.least(place, F.lit(bins - 1).cast("long"))).otherwise(F.lit(0).cast("long"))
    return F.when(value.isNull() | F.isnan(value), F.lit(-1).cast("long")).otherwise(inside)


def _histogram(rows: DataFrame, columns: Sequence[str], ends: DataFrame, bins: int, side: str) -> DataFrame:
    """(column, bin, side): a row for each column and bin, counted before the shuffle."""
    values = F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").cast("double").alias("value")) for c in columns])
    long = rows.select(F.inline(values)).join(F.broadcast(ends), "column")
    counted = long.groupBy("column", _bin(F.col("value"), F.col("low"), F.col("high"), bins).alias("bin"))
    return counted.agg(F.count("*").alias(side))


def fidelity(original: DataFrame, released: DataFrame, columns: Sequence[str], bins: int = BINS) -> DataFrame:
    """(column, n_original, n_released, ks, total_variation, chi_square, ks_error) for numeric columns that both tables have.

    Both tables become histograms over the same equal-width bins, which tasks add up before the shuffle; what comes together is one
    row a column and bin. `ks` is the largest difference of the cumulative shares at the bins' borders; between borders it
    can be larger by at most `ks_error`, the larger share that either table has in any one bin. `chi_square` is the
    two-sample statistic, `total_variation` half the sum of the differences of shares. Missing values, and those that are no numbers,
    are a bin of their own before all others. A table without rows has no distances.
    """
    spans = [F.min(F.when(~F.isnan(v), v)).alias(f"low{k}") for k, v in enumerate(_doubles(columns))]
    spans += [F.max(F.when(~F.isnan(v), v)).alias(f"high{k}") for k, v in enumerate(_doubles(columns))]
    both = original.select(*_doubles(columns)).union(released.select(*_doubles(columns)))
    entries = [F.struct(F.lit(c).alias("column"), F.col(f"low{k}").alias("low"), F.col(f"high{k}").alias("high")) for k, c in enumerate(columns)]
    # One row a column.
    ends = both.agg(*spans).select(F.inline(F.array(*entries)))
    ours, theirs = (_histogram(t, columns, ends, bins, side) for t, side in ((original, "o"), (released, "r")))
    met = ours.join(theirs, ["column", "bin"], "full").na.fill(0, ["o", "r"])
    bars = F.array_sort(F.collect_list(F.struct("bin", "o", "r")))
    # At most bins + 1 entries a column.
    found = met.groupBy("column").agg(F.sum("o").alias("n_original"), F.sum("r").alias("n_released"), bars.alias("bars"))
    n, m = F.col("n_original").cast("decimal(38,0)"), F.col("n_released").cast("decimal(38,0)")

    def running(state: Column, bar: Column) -> Column:
        total = state["total"] + bar["o"] * m - bar["r"] * n
        return F.struct(total.cast("decimal(38,0)").alias("total"), F.greatest(state["most"], F.abs(total)).cast("decimal(38,0)").alias("most"))

    zero = F.lit(0).cast("decimal(38,0)")
    most = F.aggregate("bars", F.struct(zero.alias("total"), zero.alias("most")), running)["most"]
    apart = F.aggregate("bars", zero, lambda t, b: (t + F.abs(b["o"] * m - b["r"] * n)).cast("decimal(38,0)"))
    whole = (n * m).cast("double")

    def term(bar: Column) -> Column:
        gap = (bar["o"] * m - bar["r"] * n).cast("double")
        return F.floor(gap * gap / whole / (bar["o"] + bar["r"]) * _SCALE).cast("long")

    chi = F.aggregate("bars", F.lit(0).cast("long"), lambda t, b: t + term(b))
    shares = F.transform("bars", lambda b: F.greatest(b["o"].cast("double") / F.col("n_original"), b["r"].cast("double") / F.col("n_released")))
    some = (F.col("n_original") > 0) & (F.col("n_released") > 0)
    return found.select(
        "column", "n_original", "n_released",
        *[F.when(some, v).alias(name) for name, v in {
            "ks": most.cast("double") / whole,
            "total_variation": apart.cast("double") / whole / 2,
            "chi_square": chi / F.lit(float(_SCALE)),
            "ks_error": F.array_max(shares),
        }.items()],
    )


def _doubles(columns: Sequence[str]) -> list[Column]:
    return [F.col(f"`{c}`").cast("double") for c in columns]
