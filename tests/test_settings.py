"""Results must not depend on how Spark is set up."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as registry
from flowloom.operators.sizing import lookup_side, table_bytes

NAMES = ["flow_table", "minute_jitter", "positional_zip", "volume_allocation_exact", "weighted_assign", "domain_class", "event_order"]

SETTINGS = {
    "no adaptive execution": {"spark.sql.adaptive.enabled": "false", "spark.sql.shuffle.partitions": "5"},
    "another zone, no ANSI mode": {"spark.sql.session.timeZone": "America/New_York", "spark.sql.ansi.enabled": "false"},
    "many small partitions, nothing broadcast": {
        "flowloom.broadcastBytes": "0",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.files.maxPartitionBytes": "20000",
        "spark.sql.shuffle.partitions": "7",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    },
}


def fingerprints(spark, folder):
    found = {}
    for name in NAMES:
        df = registry.queries()[name](spark, folder)
        row = F.shiftrightunsigned(F.xxhash64(*sorted(df.columns)), 20)
        found[name] = tuple(df.agg(F.count("*"), F.sum(row)).first())
    return found


@pytest.fixture(scope="module")
def usual(spark, small):
    return fingerprints(spark, small)


@pytest.mark.parametrize("settings", SETTINGS.values(), ids=SETTINGS.keys())
def test_same_rows(spark, small, usual, settings):
    before = {name: spark.conf.get(name, None) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        assert fingerprints(spark, small) == usual
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def test_sizes(spark):
    numbers = spark.range(1000).select("id", F.lit(1.5).alias("x"))
    assert table_bytes(numbers) == table_bytes(numbers, rows=1000) == 1000 * 32
    texts = spark.range(1000).select("id", F.repeat(F.lit("é"), 500).alias("t"))
    assert table_bytes(texts) == 1000 * (16 + 16 + 16 + 1000)
    arrays = spark.range(1000).select(F.array_repeat("id", 200).alias("a"))
    assert table_bytes(arrays) > 1000 * 400


def test_broadcast_only_below_the_limit(spark):
    table = spark.range(1000)
    rows = spark.range(10**6).withColumnRenamed("id", "k")
    automatic = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        for limit, automatic_limit, marked in (("24000", "1", True), ("23999", "1", False), ("24000", "-1", False)):
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", automatic_limit)
            spark.conf.set("flowloom.broadcastBytes", limit)
            joined = rows.join(lookup_side(table), F.col("k") == F.col("id"))
            assert ("BroadcastHashJoin" in joined._jdf.queryExecution().executedPlan().toString()) is marked
    finally:
        spark.conf.unset("flowloom.broadcastBytes")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", automatic)
