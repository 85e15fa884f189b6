"""Value lists: distinct, first and last occurrences, cleaning, pinning and weights."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowloom.operators.positions import numbered


def distinct_values(df: DataFrame, column: str, name: str | None = None) -> DataFrame:
    """One column, every value once, missing values left out."""
    return df.select(F.col(column).alias(name or column)).filter(F.col(name or column).isNotNull()).distinct()


def url_host(url: str) -> Column:
    """Host of a URL; a text that is no URL has none."""
    return F.try_parse_url(F.col(url), F.lit("HOST"))


def host_list(pages: DataFrame, url: str = "url") -> DataFrame:
    """Every host that occurs in a column of URLs."""
    return distinct_values(pages.select(url_host(url).alias("host")), "host")


def first_seen_distinct(df: DataFrame, value: str, pos: str) -> DataFrame:
    """Distinct values with the position of their first appearance, which says their order."""
    return df.groupBy(value).agg(F.min(pos).alias("pos"))


def keyed_last_wins(df: DataFrame, key: str, value: str, pos: str) -> DataFrame:
    """One row per key: position of its first occurrence, value of its last."""
    return df.groupBy(key).agg(F.min(pos).alias("pos"), F.max_by(value, pos).alias(value))


def port_clean(df: DataFrame, raw: str = "raw", pos: str = "pos") -> DataFrame:
    """Whole numbers among raw texts, each once at its first position; gaps, ranges and words are dropped."""
    numbers = df.select(F.col(pos).alias("pos"), F.col(raw).try_cast("int").alias("port"))
    return numbers.filter(F.col("port").isNotNull()).groupBy("port").agg(F.min("pos").alias("pos"))


def preferred_first(df: DataFrame, value: str, pos: str, preferred: Sequence) -> DataFrame:
    """The named values at the head in the order given, all others behind them in their order.

    Positions are renumbered from 0. A named value that is absent is an error.
    """
    return preferred_list(df, value, pos, preferred)[0]


def preferred_list(df: DataFrame, value: str, pos: str, preferred: Sequence) -> tuple[DataFrame, int]:
    """The same, with the number of values, which is known from numbering them."""
    named = list(preferred)
    rank = F.lit(len(named))
    for place, wanted in reversed(list(enumerate(named))):
        rank = F.when(F.col(value) == F.lit(wanted), place).otherwise(rank)
    ordered = df.select(rank.alias("_rank"), F.col(pos).alias("_pos"), F.col(value))
    placed, count = numbered(ordered, "_rank", "_pos")
    # The head holds the named values that are there, at most as many as were named.
    head = {row["_rank"] for row in placed.filter(F.col("pos") < len(named)).select("_rank").collect()} if named else set()
    absent = [wanted for place, wanted in enumerate(named) if place not in head]
    if absent:
        raise ValueError(f"preferred values {absent} are not in the list")
    return placed.select("pos", value), count


def weight_table(values: DataFrame, value: str, favoured: int, k: int = 2, count: int | None = None) -> DataFrame:
    """Whole-number weights for a list with dense positions and the favoured values at its head.

    Of n values, the m = n - favoured others weigh 1 each and a favoured one weighs k * m: with two
    favoured values and k = 2 that is 40 %, 40 % and 20 % for the rest together. `hi` is the running
    sum of weights; it follows from the position, so nothing has to be summed in order. `count` is the number of values,
    if the caller knows it.
    """
    others = (values.count() if count is None else count) - favoured
    if others < 1:
        raise ValueError(f"a weight table needs more than {favoured} values")
    heavy = k * others
    pos = F.col("pos").cast("long")
    is_favoured = pos < favoured
    weight = F.when(is_favoured, F.lit(heavy)).otherwise(F.lit(1)).cast("long")
    hi = F.when(is_favoured, (pos + 1) * heavy).otherwise(F.lit(favoured * heavy - favoured + 1) + pos)
    return values.select("pos", value, weight.alias("w"), hi.cast("long").alias("hi"))
