"""Generalisation of a table before its release, until every group of like rows has k rows or more."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from itertools import product

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowloom.sources.staging import stage


def _key(name: str, level: int) -> str:
    return f"_{name}_{level}"


def _counted(rows: DataFrame, levels: Mapping[str, Sequence[Column]]) -> DataFrame:
    """One row for each group at the finest levels, with all coarser values of it and its number of rows."""
    keys = [c.alias(_key(name, k)) for name, own in levels.items() for k, c in enumerate(own)]
    return rows.select(*keys).groupBy(*[_key(name, k) for name, own in levels.items() for k in range(len(own))]).agg(F.count("*").alias("_n"))


def least_levels(
    rows: DataFrame, levels: Mapping[str, Sequence[Column]], k: int, losses: Mapping[str, Sequence[float]] | None = None
) -> dict[str, int]:
    """The level of each column at which every group has at least k rows, with the least loss.

    `levels` gives for each column its forms from fine to coarse; each must follow from the one before, so that groups only grow. The loss
    of a choice is the sum of `losses` of its levels, by default the share of a column's levels that are given up; they must not fall from a
    level to a coarser one. Of equal losses the first in the order of columns counts, fine before coarse.

    The table is read once, into counts of its finest groups; each choice that is tried sums these up. Choices are tried by loss,
    so the first that holds is the best; one that fails rules out all that are nowhere coarser. An empty table needs nothing.
    If even the coarsest choice has a group below k, that is an error.
    """
    names = list(levels)
    losses = losses or {n: [i / max(1, len(own) - 1) for i in range(len(own))] for n, own in levels.items()}
    groups = stage(_counted(rows, levels), "groups")
    choices = sorted(product(*[range(len(levels[n])) for n in names]), key=lambda c: (sum(losses[n][i] for n, i in zip(names, c, strict=True)), c))
    failed: list[tuple[int, ...]] = []
    for choice in choices:
        if any(all(i <= j for i, j in zip(choice, bad, strict=True)) for bad in failed):
            continue
        sums = groups.groupBy(*[_key(n, i) for n, i in zip(names, choice, strict=True)]).agg(F.sum("_n").alias("_n"))
        smallest = sums.agg(F.min("_n")).first()[0]
        if smallest is None or smallest >= k:
            return dict(zip(names, choice, strict=True))
        failed.append(choice)
    raise ValueError(f"even the coarsest levels leave a group of fewer than {k} rows")


def generalised(rows: DataFrame, levels: Mapping[str, Sequence[Column]], k: int, **settings) -> DataFrame:
    """All rows, the named columns at the levels of `least_levels`; every combination of them is that of k rows or more."""
    chosen = least_levels(rows, levels, k, **settings)
    others = [F.col(f"`{c}`") for c in rows.columns if c not in levels]
    return rows.select(*others, *[levels[n][i].alias(n) for n, i in chosen.items()])
