"""Generalisation until every group has k rows, against trying every choice."""

import random
from collections import Counter
from itertools import product

import pytest
from pyspark.sql import functions as F

from flowloom.operators import suppression

LEVELS = {"a": [1, 4, 16, 1000], "b": [1, 5, 1000], "c": [1, 1000]}


def columns():
    return {n: [F.floor(F.col(n) / step).cast("long") for step in steps] for n, steps in LEVELS.items()}


def best(rows, k, losses):
    """Every choice, by loss."""
    found = []
    for choice in product(*[range(len(steps)) for steps in LEVELS.values()]):
        groups = Counter(tuple(v // LEVELS[n][i] for v, n, i in zip(row, LEVELS, choice, strict=True)) for row in rows)
        if min(groups.values()) >= k:
            found.append((sum(losses[n][i] for n, i in zip(LEVELS, choice, strict=True)), choice))
    return min(found)[1] if found else None


@pytest.mark.parametrize("seed", range(4))
def test_least_loss(spark, seed):
    rnd = random.Random(seed)
    rows = [(rnd.randint(0, 31), rnd.randint(0, 9), rnd.choice([0, 0, 0, 1])) for _ in range(rnd.choice([60, 400]))]
    table = spark.createDataFrame(rows, "a long, b long, c long")
    even = {n: [i / (len(s) - 1) for i in range(len(s))] for n, s in LEVELS.items()}
    uneven = {"a": [0, 1, 2, 9], "b": [0, 0.5, 4], "c": [0, 20]}
    for losses in (even, uneven):
        for k in (2, 10):
            assert tuple(suppression.least_levels(table, columns(), k, losses).values()) == best(rows, k, losses)


def test_released_rows(spark):
    rnd = random.Random(9)
    rows = [(i, rnd.randint(0, 31), rnd.randint(0, 9), 0) for i in range(300)]
    table = spark.createDataFrame(rows, "id long, a long, b long, c long")
    out = suppression.generalised(table, columns(), 7)
    assert out.count() == 300 and out.columns == ["id", "a", "b", "c"]
    assert out.groupBy("a", "b", "c").count().agg(F.min("count")).first()[0] >= 7
    with pytest.raises(ValueError, match="coarsest"):
        suppression.least_levels(table, columns(), 301)
    assert suppression.least_levels(table.limit(0), columns(), 5) == {"a": 0, "b": 0, "c": 0}
