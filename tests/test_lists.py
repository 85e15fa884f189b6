import pytest
from pyspark.sql import functions as F

from flowloom.operators.columns import typed_projection
from flowloom.operators.lists import (
    first_seen_distinct,
    host_list,
    keyed_last_wins,
    port_clean,
    preferred_first,
    weight_table,
)
from flowloom.operators.positions import nth_in_group, numbered, offset_table, positional_zip, with_position


def listed(spark, *values, kind="string"):
    return spark.createDataFrame(list(enumerate(values)), f"pos int, value {kind}")


def test_host_list(spark):
    urls = ["http://a.example.com/x?y=1", "https://a.example.com:8080/", "no url", "http://b.example.com#t", None, "http://bad url/"]
    pages = spark.createDataFrame([(u,) for u in urls], "url string")
    assert sorted(r[0] for r in host_list(pages).collect()) == ["a.example.com", "b.example.com"]


def test_first_seen(spark):
    rows = first_seen_distinct(listed(spark, "x", "y", "x", "z"), "value", "pos").collect()
    assert [(r["value"], r["pos"]) for r in rows] == [("x", 0), ("y", 1), ("z", 3)]


def test_keyed_last_wins(spark):
    rows = spark.createDataFrame([("a", 1, 0), ("b", 2, 1), ("a", 3, 2)], "key string, value int, pos int")
    assert sorted(map(tuple, keyed_last_wins(rows, "key", "value", "pos").collect())) == [("a", 0, 3), ("b", 1, 2)]


def test_port_clean(spark):
    raw = listed(spark, "80", " 443 ", "80-90", None, "abc", "+81", "080", "80.5", "")
    rows = port_clean(raw, "value", "pos").orderBy("pos").collect()
    assert [(r["port"], r["pos"]) for r in rows] == [(80, 0), (443, 1), (81, 5)]


def test_preferred_first(spark):
    ports = listed(spark, 1, 443, 80, 2, kind="int")
    rows = preferred_first(ports, "value", "pos", [80, 443]).orderBy("pos").collect()
    assert [(r["pos"], r["value"]) for r in rows] == [(0, 80), (1, 443), (2, 1), (3, 2)]
    with pytest.raises(ValueError, match="not in the list"):
        preferred_first(listed(spark, 1, 2, kind="int"), "value", "pos", [80])


def test_weight_table(spark):
    values = preferred_first(listed(spark, 1, 80, 2, 443, 3, kind="int"), "value", "pos", [80, 443])
    rows = weight_table(values, "value", 2).orderBy("pos").collect()
    assert [r["value"] for r in rows] == [80, 443, 1, 2, 3]
    assert [r["w"] for r in rows] == [6, 6, 1, 1, 1]
    assert [r["hi"] for r in rows] == [6, 12, 13, 14, 15]
    with pytest.raises(ValueError):
        weight_table(listed(spark, 80, 443, kind="int"), "value", 2)


def test_weights_of_the_usual_port_list(spark):
    ports = spark.range(6177).select(F.col("id").alias("pos"), F.col("id").alias("port"))
    top = weight_table(ports, "port", 2).orderBy("pos").first()
    assert top["w"] == 12_350


def test_positions_over_many_partitions(spark):
    # A third of the rows share the leading order column; the second one splits them.
    rows = spark.range(0, 90_000, 1, 7).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("a"), F.xxhash64("id").alias("b"), "id"
    )
    placed, count = numbered(rows, "-a", "b")
    assert count == 90_000
    assert placed.count() == 90_000
    found = [(r["a"], r["b"], r["pos"]) for r in placed.collect()]
    expected = sorted(((a, b) for a, b, _ in found), key=lambda r: (-r[0], r[1]))
    assert [(a, b) for a, b, _ in sorted(found, key=lambda r: r[2])] == expected
    assert sorted(p for _, _, p in found) == list(range(90_000))


def test_a_repeated_order_is_an_error(spark):
    rows = spark.range(1000).select((F.col("id") % 400).alias("k"), "id")
    with pytest.raises(ValueError, match="not unique"):
        with_position(rows, "k")
    with pytest.raises(ValueError, match="not unique"):
        positional_zip(rows, ["id"], rows, ["-k"])
    assert with_position(rows, "-k", "id").count() == 1000


def test_offsets_of_many_partitions(spark):
    offsets, total = offset_table(spark, {part: part % 3 for part in range(20_000)})
    assert total == sum(part % 3 for part in range(20_000)) and offsets.count() == 20_000
    assert [tuple(r) for r in offsets.orderBy("_part").tail(2)] == [(19_998, total - 1), (19_999, total - 1)]


def test_place_in_a_hot_group(spark):
    """Half of all rows in one group, some without a cell, and no join or order on the group alone."""
    rows = spark.range(0, 20_000, 1, 5).select(
        F.when(F.col("id") % 2 == 0, "hot").otherwise(F.when(F.col("id") % 3 > 0, (F.col("id") % 50).cast("string"))).alias("g"),
        F.when(F.col("id") % 11 > 0, F.pmod(F.xxhash64("id"), F.lit(1000))).alias("v"),
        "id",
    )
    automatic = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        placed = nth_in_group(rows, ["g"], [F.floor(F.col("v") / 100), F.col("v") % 100], ["id"])
        plan = placed._jdf.queryExecution().executedPlan().toString()
        found = [tuple(r) for r in placed.collect()]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", automatic)
    expected, seen = [], {}
    for g, v, i in sorted(((r[0], r[1], r[2]) for r in found), key=lambda r: (r[0] or "", -1 if r[1] is None else r[1], r[2])):
        seen[g] = seen.get(g, 0) + 1
        expected.append((g, v, i, seen[g]))
    assert len(found) == 20_000 and sorted(found, key=str) == sorted(expected, key=str)
    assert "Cartesian" not in plan and "NestedLoop" not in plan


def test_positions_of_nothing(spark):
    placed, count = numbered(spark.range(0), "id")
    assert count == 0 and placed.count() == 0


def test_zip(spark):
    left = spark.createDataFrame([(3, "c"), (1, "a"), (2, "b")], "k int, l string")
    right = spark.createDataFrame([("z",), ("x",), ("y",)], "r string")
    rows = positional_zip(left, ["k"], right, ["r"]).orderBy("pos").collect()
    assert [(r["l"], r["r"]) for r in rows] == [("a", "x"), ("b", "y"), ("c", "z")]
    with pytest.raises(ValueError, match="cannot zip 3 rows with 2 rows"):
        positional_zip(left, ["k"], right.limit(2), ["r"])


def test_positions_keep_names_with_dots(spark):
    rows = spark.createDataFrame([(2,), (1,)], "`a.b` int")
    assert [tuple(r) for r in with_position(rows, "`a.b`").orderBy("pos").collect()] == [(1, 0), (2, 1)]


def test_typed_projection(spark):
    raw = spark.createDataFrame(
        [("tom", "9", "basketball", "30"), ("alan", "three", "soccer", "40")],
        "name string, age string, cca string, weight string",
    )
    typed = typed_projection(raw, "name string, age bigint, weight bigint, cca string")
    assert [f.dataType.simpleString() for f in typed.schema] == ["string", "bigint", "bigint", "string"]
    assert [tuple(r) for r in typed.collect()] == [("tom", 9, 30, "basketball"), ("alan", None, 40, "soccer")]
