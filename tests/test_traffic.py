from datetime import datetime, timedelta

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import Window
from pyspark.sql import functions as F

from flowloom.functions.clock import bound, path_label, path_text, slot_of, timestamp_text, window_minutes
from flowloom.operators.traffic import (
    density_check,
    expected_vs_actual,
    minute_jitter,
    minute_profile,
    profile_window,
    row_expansion,
    tick_rollup,
    volume_allocation,
    volume_allocation_exact,
    volume_total,
)

START = datetime(2020, 6, 23, 11, 0)


def window_of(spark, *values):
    rows = [(i, START + timedelta(minutes=i), i, n) for i, n in enumerate(values)]
    return spark.createDataFrame(rows, "i int, minute_ts timestamp_ntz, slot int, n bigint")


def allocation_of(spark, *counts):
    rows = [(i, START + timedelta(minutes=i), c) for i, c in enumerate(counts)]
    return spark.createDataFrame(rows, "i int, minute_ts timestamp_ntz, c bigint")


def at(spark, *times):
    return spark.createDataFrame([(t,) for t in times], "ts timestamp_ntz")


def counts(df):
    return [r["c"] for r in df.orderBy("i").collect()]


def test_slots():
    assert slot_of(datetime(2020, 6, 23, 11, 0)) == 0
    assert slot_of(datetime(2020, 6, 23, 10, 59)) == 1439
    assert slot_of(datetime(2020, 6, 23, 0, 0)) == 780


def test_bounds():
    assert bound("3/6/2020 9:05") == datetime(2020, 6, 3, 9, 5)
    assert window_minutes("23/6/2020 11:00", "23/6/2020 13:00") == 120
    for end in ("23/6/2020 11:00", "23/6/2020 10:59"):
        with pytest.raises(ValueError):
            window_minutes("23/6/2020 11:00", end)


def test_profile_counts_by_slot_and_fills_gaps(spark):
    events = at(spark, datetime(2024, 1, 1, 11, 0, 59), datetime(2024, 1, 2, 11, 0), datetime(2024, 1, 2, 10, 59), None)
    rows = {r["slot"]: r["n"] for r in minute_profile(events).collect()}
    assert len(rows) == 1440
    assert {s: n for s, n in rows.items() if n} == {0: 2, 1439: 1}


def test_profile_window_wraps(spark):
    profile = spark.range(1440).select(F.col("id").cast("int").alias("slot"), (F.col("id") * 10).alias("n"))
    rows = profile_window(profile, "23/6/2020 10:30", "23/6/2020 11:10").orderBy("i").collect()
    assert [r["slot"] for r in rows] == [*range(1410, 1440), *range(10)]
    assert [r["n"] for r in rows] == [10 * r["slot"] for r in rows]
    assert rows[-1]["minute_ts"] == datetime(2020, 6, 23, 11, 9)
    days = profile_window(profile, "23/6/2020 11:00", "26/6/2020 11:00")
    assert days.count() == 3 * 1440
    assert {r["k"] for r in days.groupBy("slot").agg(F.count("*").alias("k")).collect()} == {3}


def test_allocation(spark):
    window = window_of(spark, 1, 1, 2)
    allocation = volume_allocation(window, 10)
    assert counts(allocation) == [2, 2, 5]
    assert volume_total(allocation, 10).first().asDict() == {"requested": 10, "allocated": 9, "lost": 1}
    assert counts(volume_allocation_exact(window, 10)) == [3, 2, 5]


@pytest.mark.parametrize("total", [0, 1, 7, 999, 123_456_789_012])
def test_exact_allocation_is_largest_remainder(spark, total):
    values = [3, 0, 5, 7, 7, 1, 11, 2]
    whole = sum(values)
    base = [v * total // whole for v in values]
    by_rest = sorted(range(len(values)), key=lambda i: (-(values[i] * total % whole), i))
    for i in by_rest[: total - sum(base)]:
        base[i] += 1
    assert counts(volume_allocation_exact(window_of(spark, *values), total)) == base


@pytest.mark.parametrize("total", [1, 30_000, 3_000_001, 10**13])
def test_allocation_rounds_half_to_even(spark, total):
    values = [(i * i * 7919) % 97 for i in range(1440)]
    whole = sum(values)
    expected = [round(v * (total / whole)) for v in values]
    assert counts(volume_allocation(window_of(spark, *values), total)) == expected


def test_rounding_loses_at_most_half_a_row_per_minute(spark):
    values = [(i * 37) % 23 + 1 for i in range(500)]
    lost = volume_total(volume_allocation(window_of(spark, *values), 7_777), 7_777).first()["lost"]
    assert abs(lost) <= 250


def test_expected_vs_actual(spark):
    window = window_of(spark, 1, 1, 2)
    rows = expected_vs_actual(window, volume_allocation(window, 10)).orderBy("i").collect()
    assert [r["expected_share"] for r in rows] == [0.25, 0.25, 0.5]
    assert [r["difference"] for r in rows] == [-0.25, -0.25, 0.5]


def test_expansion(spark):
    rows = row_expansion(allocation_of(spark, 2, 0, 1)).orderBy("id").collect()
    assert [(r["i"], r["k"]) for r in rows] == [(0, 1), (0, 2), (2, 1)]
    assert len({r["id"] for r in rows}) == 3


@pytest.mark.parametrize("expected", [None, 10, 3_000_000])
def test_expansion_of_a_hot_minute(spark, expected):
    rows = row_expansion(allocation_of(spark, 40_000, 1_000_001, 8192, 8193, 1), expected)
    assert rows.groupBy("i").agg(F.count("*").alias("n"), F.max("k").alias("k")).orderBy("i").collect() == [
        (0, 40_000, 40_000),
        (1, 1_000_001, 1_000_001),
        (2, 8192, 8192),
        (3, 8193, 8193),
        (4, 1, 1),
    ]
    assert rows.select("id").distinct().count() == 1_056_387
    if expected is None:
        largest = rows.groupBy(F.spark_partition_id().alias("p")).count().agg(F.max("count")).first()[0]
        assert largest < 400_000, "a hot minute must be shared by tasks"


def test_jitter_stays_in_its_minute_and_orders_by_time(spark):
    rows = row_expansion(allocation_of(spark, 5, 30_000, 40))
    timed = minute_jitter(rows).join(rows.select("id", "minute_ts"), "id")
    by_minute = Window.partitionBy("i").orderBy("ts", "id")
    checks = timed.select(
        (F.row_number().over(by_minute) == F.col("nth")).alias("ordinal"),
        (F.col("ts") >= F.col("minute_ts")).alias("after"),
        (F.col("ts") < F.timestamp_add("MINUTE", F.lit(1), "minute_ts")).alias("before"),
        (F.col("ts_text") == F.date_format("ts", "dd/MM/yyyy HH:mm:ss.SSS")).alias("text"),
    )
    assert checks.filter("ordinal and after and before and text").count() == 30_045


def test_rows_do_not_depend_on_partitions(spark):
    allocation = allocation_of(spark, 500, 20_000, 3)
    first = minute_jitter(row_expansion(allocation))
    other = minute_jitter(row_expansion(allocation.repartition(3), 20_503).repartition(5))
    assert first.exceptAll(other).count() == 0 and other.exceptAll(first).count() == 0


def test_ticks(spark):
    events = at(spark, datetime(2024, 1, 1, 10, 4, 59), datetime(2024, 1, 1, 10, 0), datetime(2024, 1, 1, 10, 16), None)
    rows = tick_rollup(events).orderBy("tick").collect()
    assert [(r["label"], r["n"]) for r in rows] == [("10:00", 2), ("10:05", 0), ("10:10", 0), ("10:15", 1)]
    assert tick_rollup(at(spark)).count() == 0


def test_many_ticks(spark):
    events = at(spark, datetime(2024, 1, 1), datetime(2024, 1, 2))
    rows = tick_rollup(events, every="1 second")
    assert rows.count() == 86_401
    assert rows.agg(F.max("tick"), F.sum("n")).first() == (datetime(2024, 1, 2), 2)


@pytest.mark.parametrize(("n", "passes"), [(30_000, True), (29_999, False)])
def test_density(spark, n, passes):
    events = spark.range(n).select(
        F.timestamp_add("SECOND", (F.col("id") % 86_400).cast("int"), F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")).alias("ts")
    )
    assert [r["passes"] for r in density_check(events).collect()] == [passes]
    if not passes:
        with pytest.raises(PySparkException, match="too few rows"):
            density_check(events, strict=True).collect()


def test_density_sees_empty_windows(spark):
    events = at(spark, datetime(2024, 1, 1, 5), datetime(2024, 1, 3, 5))
    rows = density_check(events, min_per_minute=1 / 1440).orderBy("window_start").collect()
    assert [r["passes"] for r in rows] == [True, False, True]


def test_path_labels(spark):
    assert path_text("23/6/2020 11:00") == "2362020_1100"
    text = spark.createDataFrame([("23/6/2020 11:00",)], "t string")
    assert text.select(path_label("t")).first()[0] == "2362020_1100"


def test_timestamp_text_in_a_zone_that_skips_the_hour(spark):
    skipped = at(spark, datetime(2024, 3, 10, 2, 30, 1, 50_000), datetime(2024, 3, 10, 2, 30))
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        texts = [r[0] for r in skipped.select(timestamp_text("ts")).collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert texts == ["10/03/2024 02:30:01.050", "10/03/2024 02:30:00.000"]
