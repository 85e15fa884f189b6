"""The keyed table that grows by batches, and distances between tables, against plain versions."""

import os
import random
from itertools import permutations

import numpy as np
import pytest
from pyspark.sql import functions as F

from flowloom.operators.fidelity import fidelity
from flowloom.operators.lists import keyed_last_wins
from flowloom.sources.keyedtable import KeyedTable

SCHEMA = "host string, url string, page long"


def pages(spark, number=600, seed=1):
    rnd = random.Random(seed)
    rows = [(rnd.choice([None, *(f"h{k:03d}" for k in range(80))]), f"u{i}", i) for i in range(number)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def table_of(spark, path, ranges=8):
    return KeyedTable(spark, str(path), "host", "url", "page", ranges)


def test_batches_in_any_order(spark, tmp_path):
    rows = pages(spark)
    wanted = sorted(map(tuple, keyed_last_wins(rows, "host", "url", "page").select("host", "pos", "url").collect()), key=str)
    for k, order in enumerate(permutations(range(3))):
        table = table_of(spark, tmp_path / str(k))
        for part in order:
            table.merge(rows.filter(F.col("page") % 3 == part), f"b{part}")
        assert sorted(map(tuple, table.rows().select("host", "page", "url").collect()), key=str) == wanted


def test_a_batch_again_changes_nothing(spark, tmp_path):
    table, rows = table_of(spark, tmp_path / "t"), pages(spark)
    table.merge(rows, "one")
    before, commits = sorted(table.rows().collect(), key=str), table.commits()
    assert table.merge(rows, "one") == [] and table.commits() == commits
    # Under another id it is merged again, to the same rows.
    assert table.merge(rows.filter("page < 100"), "two") != []
    assert sorted(table.rows().collect(), key=str) == before


def test_only_touched_ranges(spark, tmp_path):
    table, rows = table_of(spark, tmp_path / "t"), pages(spark)
    table.merge(rows, "one")
    before = table.state()["folders"]
    late = spark.createDataFrame([("h000", "new", 10_000), ("h001", "new", 10_001)], SCHEMA)
    [touched] = table.merge(late, "two")
    after = table.state()["folders"]
    assert {k for k in after if after[k] != before[k]} == {str(touched)} and len(after) > 4
    assert table.rows().filter("url = 'new'").count() == 2
    assert table.vacuum() == 1 and table.rows().count() == 81 and table.vacuum() == 0


def test_a_failed_merge_changes_nothing(spark, tmp_path):
    table, rows = table_of(spark, tmp_path / "t"), pages(spark)
    table.merge(rows.filter("page < 300"), "one")
    before = sorted(table.rows().collect(), key=str)
    broken = rows.withColumn("url", F.when(F.col("page") < 599, F.col("url")).otherwise(F.raise_error(F.lit("torn")).cast("string")))
    with pytest.raises(Exception, match="torn"):
        table.merge(broken, "two")
    assert sorted(table.rows().collect(), key=str) == before and table.commits() == [1]
    # Another merge was quicker.
    other = table_of(spark, tmp_path / "t")
    stale = other.state()
    table.merge(rows, "two")
    with pytest.raises(RuntimeError, match="another merge"):
        other._commit(stale | {"number": 2})
    assert not [f for f in os.listdir(tmp_path / "t" / "_commits") if f.endswith(".draft")]


def test_empty_keyed_table(spark, tmp_path):
    table = table_of(spark, tmp_path / "t")
    with pytest.raises(ValueError, match="no rows"):
        table.rows()
    table.merge(pages(spark).limit(0), "nothing")
    table.merge(pages(spark), "one")
    assert table.rows().count() == 81


def plain(one, two, bins):
    """Distances over the bins, and the largest difference of cumulative shares over all values."""
    pooled = np.concatenate([one, two])
    edges = np.linspace(pooled.min(), pooled.max(), bins + 1)
    cut = [np.clip(np.floor((v - edges[0]) / ((edges[-1] - edges[0]) / bins)), 0, bins - 1).astype(int) for v in (one, two)]
    a, b = (np.bincount(c, minlength=bins) / len(c) for c in cut)
    points = np.unique(pooled)
    exact = max(abs(np.searchsorted(np.sort(one), points, "right") / len(one) - np.searchsorted(np.sort(two), points, "right") / len(two)))
    return np.abs(np.cumsum(a - b)).max(), np.abs(a - b).sum() / 2, exact


@pytest.mark.parametrize("shift", [0.0, 0.4])
def test_distances(spark, shift):
    rnd = np.random.default_rng(3)
    one, two = rnd.normal(0, 1, 3000), rnd.normal(shift, 1.2, 2000)
    tables = [spark.createDataFrame([(float(v), 5.0) for v in values], "v double, same double").repartition(4) for values in (one, two)]
    found = {r["column"]: r for r in fidelity(*tables, ["v", "same"], bins=50).collect()}
    ks, variation, exact = plain(one, two, 50)
    row = found["v"]
    assert (row["n_original"], row["n_released"]) == (3000, 2000)
    assert row["ks"] == pytest.approx(ks) and row["total_variation"] == pytest.approx(variation)
    assert row["ks"] <= exact + 1e-12 and exact <= row["ks"] + row["ks_error"]
    assert tuple(found["same"])[3:6] == (0.0, 0.0, 0.0)


def test_missing_values_and_empty_tables(spark):
    table = spark.createDataFrame([(1.0,), (None,), (float("nan"),), (3.0,)], "v double")
    [row] = fidelity(table, table.filter("v = 1"), ["v"]).collect()
    # Half of the original is missing, all of the rest stays.
    assert row["ks"] == 0.5 and row["n_original"] == 4 and row["n_released"] == 1
    [row] = fidelity(table, table.limit(0), ["v"]).collect()
    assert row["ks"] is None and row["n_released"] == 0
    assert fidelity(table.limit(0), table.limit(0), ["v"]).collect() == []
