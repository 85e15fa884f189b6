import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as registry
from flowloom.functions.addresses import dotted_quad
from flowloom.functions.draws import draw, label
from flowloom.operators import assign
from flowloom.operators.assign import bucket_assign, size_fields, weighted_assign
from flowloom.operators.entities import (
    address_dim,
    address_pool,
    domain_class,
    endpoint_enrich,
    endpoint_pairs,
    flag_generated,
)
from flowloom.operators.graph import flow_edges, flow_nodes
from flowloom.operators.lists import host_list, weight_table
from flowloom.plans import flows as plan


def plan_text(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def shuffled_lookups(spark):
    """No lookup table is small enough to be broadcast."""
    settings = {
        "flowloom.broadcastBytes": "0",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    for name, value in settings.items():
        spark.conf.set(name, value)
    yield
    for name in settings:
        spark.conf.unset(name)


def ports_by_weight(spark, n, favoured=2):
    return weight_table(spark.range(n).select(F.col("id").alias("pos"), (F.col("id") + 1000).alias("port")), "port", favoured)


def test_dotted_quads(spark):
    rows = spark.createDataFrame([(1,), (16909060,), (4294967295,)], "n bigint")
    assert [r[0] for r in rows.select(dotted_quad("n")).collect()] == ["0.0.0.1", "1.2.3.4", "255.255.255.255"]


def test_draws_are_uniform_and_independent(spark):
    rows = spark.range(200_000).select(draw(10, "a", "id").alias("a"), draw(10, "b", "id").alias("b"))
    cells = [r["count"] for r in rows.groupBy("a", "b").count().collect()]
    assert len(cells) == 100 and min(cells) > 1800 and max(cells) < 2200


def test_labels(spark):
    labels = [r[0] for r in spark.range(5000).select(label("x", "id")).collect()]
    assert all(re.fullmatch("[a-z0-9]{5,10}", text) for text in labels)
    assert {len(text) for text in labels} == set(range(5, 11))
    assert len(set("".join(labels))) == 36
    assert len(set(labels)) > 4990


def test_addresses_depend_on_the_secret_only(spark):
    events = spark.range(1000).select((F.col("id") % 300).alias("user_id"))
    first, again, other = (address_dim(events, "user_id", s).collect() for s in ("s", "s", "t"))
    assert sorted(first) == sorted(again)
    assert not {r["ip"] for r in first} & {r["ip"] for r in other}
    assert [r["key"] for r in sorted(first, key=lambda r: r["pos"])] == list(range(300))


def test_colliding_keys_share_one_pool_entry(spark, monkeypatch):
    monkeypatch.setattr("flowloom.operators.entities.keyed_address", lambda key, secret: F.col(key) % 4 + 1)
    events = spark.range(10).select((F.col("id") + 2).alias("user_id"))
    dim = address_dim(events, "user_id", "s").collect()
    assert sorted(r["same_ip"] for r in dim) == [2] * 4 + [3] * 6
    pool, count = address_pool(events, "user_id", "s")
    pool = pool.orderBy("pos").collect()
    assert count == 4
    # Keys 2, 3, 4, 5 are the first of their addresses.
    assert [(r["pos"], r["ip_number"]) for r in pool] == [(0, 3), (1, 4), (2, 1), (3, 2)]


def test_classes(spark):
    dim = spark.range(6).select(F.col("id").alias("pos"), (F.col("id") + 1).alias("ip_number"), F.lit("h.example.com").alias("host"))
    rows = domain_class(dim, 2, 3).orderBy("pos").collect()
    assert [r["class"] for r in rows] == ["generated"] * 2 + ["missing"] * 3 + ["known"]
    assert all(re.fullmatch(r"[a-z0-9]{5,10}DGA\.com", r["host"]) for r in rows[:2])
    assert [r["host"] for r in rows[2:]] == [None, None, None, "h.example.com"]
    with pytest.raises(ValueError):
        domain_class(dim, 4, 3)


def test_endpoints_are_uniform_over_ordered_pairs(spark):
    pairs = endpoint_pairs(spark.range(60_000), "id", 4)
    cells = {(r["src"], r["dst"]): r["count"] for r in pairs.groupBy("src", "dst").count().collect()}
    assert set(cells) == {(a, b) for a in range(4) for b in range(4) if a != b}
    assert min(cells.values()) > 4600 and max(cells.values()) < 5400
    with pytest.raises(ValueError):
        endpoint_pairs(spark.range(1), "id", 1)


def test_buckets_and_sizes(spark):
    rows = size_fields(bucket_assign(spark.range(50_000), "id"), "id")
    low, high = rows.agg(F.min("protocol"), F.max("protocol")).first()
    assert (low, high) == (0, 143)
    wrong = "bytes < 1500 or bytes > 30000 or packets not between 1 and 20 or bytes * 10 != round(bytes * 10)"
    assert rows.filter(wrong).count() == 0
    given = spark.createDataFrame([(1, 1500.0), (2, 1500.1), (3, 30000.0)], "id bigint, amount double")
    assert [r["packets"] for r in size_fields(given, "id", "amount").orderBy("id").collect()] == [1, 2, 20]


def brute_force(rows, weights, tickets):
    table = [(r["hi"] - r["w"], r["hi"], r["port"]) for r in weights.collect()]
    drawn = rows.select("id", draw(tickets, "port", "id").alias("t")).collect()
    return {r["id"]: next(p for lo, hi, p in table if lo <= r["t"] < hi) for r in drawn}


@pytest.mark.parametrize("n", [3, 50, 700])
def test_weighted_assign_against_brute_force(spark, n):
    weights = ports_by_weight(spark, n)
    rows = spark.range(3000)
    tickets = 5 * (n - 2)
    found = {r["id"]: r["p"] for r in weighted_assign(rows, "id", weights, "port", {"p": "port"}).collect()}
    assert found == brute_force(rows, weights, tickets)


def test_uneven_weights(spark):
    weights = [1000, 1, 3, 500_000, 7, 0, 200]
    hi = [sum(weights[: i + 1]) for i in range(len(weights))]
    table = spark.createDataFrame(list(zip(range(7), weights, hi)), "port bigint, w bigint, hi bigint")
    rows = spark.range(20_000)
    found = {r["id"]: r["p"] for r in weighted_assign(rows, "id", table, "port", {"p": "port"}).collect()}
    assert found == brute_force(rows, table, hi[-1])


def test_favoured_ports_get_their_share(spark):
    drawn = {"s": "source port", "d": "destination port"}
    rows = weighted_assign(spark.range(100_000), "id", ports_by_weight(spark, 6177), "port", drawn)
    for side in drawn:
        shares = {r[side]: r["count"] / 100_000 for r in rows.groupBy(side).count().collect()}
        assert abs(shares[1000] - 0.4) < 0.01 and abs(shares[1001] - 0.4) < 0.01
    # The two draws are independent: 16 % of rows have the first port on both sides.
    assert abs(rows.filter("s = 1000 and d = 1000").count() / 100_000 - 0.16) < 0.01


def test_interval_join_is_an_equi_join(spark):
    rows = weighted_assign(spark.range(1000), "id", ports_by_weight(spark, 500), "port", {"p": "port"})
    text = plan_text(rows)
    assert "BroadcastHashJoin" in text and "NestedLoop" not in text and "Cartesian" not in text


def test_large_lookups_are_joined_by_shuffle(spark, shuffled_lookups):
    weights = ports_by_weight(spark, 5000)
    rows = weighted_assign(spark.range(0, 200_000, 1, 4), "id", weights, "port", {"p": "port"})
    text = plan_text(rows)
    assert "SortMergeJoin" in text and "Broadcast" not in text
    assert rows.count() == 200_000
    # The value with 40 % of the rows is spread over the partitions of the join.
    hot = rows.filter("p = 1000").groupBy(F.spark_partition_id().alias("part")).count().collect()
    assert len(hot) > 1 and max(r["count"] for r in hot) < 30_000


def flow_inputs(spark, small):
    events = spark.read.parquet(f"{small}/events.parquet")
    hosts = host_list(spark.read.parquet(f"{small}/pages.parquet"))
    ports = registry._port_text(spark.read.parquet(f"{small}/part.parquet"))
    return events, hosts, ports


def make_flows(spark, small, **options):
    settings = {"favoured": (8, 44), "fake": 3, "none": 3, **options}
    return plan.flow_rows(*flow_inputs(spark, small), "23/6/2020 11:00", "23/6/2020 13:00", 30_000, "secret", **settings)


@pytest.fixture
def expected_flows(spark, small):
    return sorted(make_flows(spark, small).collect(), key=lambda r: r["id"])


def test_flow_table(spark, small):
    flows = make_flows(spark, small)
    assert plan.FLOW_COLUMNS == flows.columns[1:]
    total = flows.count()
    assert abs(total - 30_000) <= 60
    assert flows.select("id").distinct().count() == total
    assert flows.filter("source_IP = destination_IP").count() == 0
    nulls = flows.select([F.count_if(F.col(c).isNull()).alias(c) for c in flows.columns]).first().asDict()
    assert {c for c, n in nulls.items() if n} == {"source_domainName", "destination_domainName"}
    low, high = flows.agg(F.min("timestamp").cast("string"), F.max("timestamp").cast("string")).first()
    assert "2020-06-23 11:00" <= low and high < "2020-06-23 13:00"
    per_ip = flows.groupBy("source_IP").agg(F.count_distinct(F.coalesce("source_domainName", F.lit("-"))).alias("n"))
    assert per_ip.filter("n > 1").count() == 0


def test_flow_table_is_the_same_with_shuffled_lookups(spark, small, expected_flows, shuffled_lookups):
    flows = make_flows(spark, small)
    assert plan_text(flows).count("SortMergeJoin") >= 4
    assert sorted(flows.collect(), key=lambda r: r["id"]) == expected_flows


def test_flow_table_is_the_same_with_common_ports_broadcast(spark, small, expected_flows, monkeypatch):
    """Too many ports for a broadcast: only flows with another than the common ones are shuffled, and as ids."""
    monkeypatch.setattr(assign, "HEAVY", 10, raising=False)
    monkeypatch.setattr(assign, "LISTED", 50, raising=False)
    spark.conf.set("flowloom.broadcastBytes", "5000")
    try:
        flows = make_flows(spark, small)
        assert sorted(flows.collect(), key=lambda r: r["id"]) == expected_flows
    finally:
        spark.conf.unset("flowloom.broadcastBytes")
    text = plan_text(flows)
    assert "LeftAnti" in text and "ShuffledHashJoin" in text
    lines = text.splitlines()
    below = [lines[i + 1] for i, line in enumerate(lines) if "Exchange hashpartitioning(_in_cell" in line]
    assert below and not any(column in line for line in below for column in ("packets", "timestamp#", "_IP"))


def test_common_and_rare_values(spark):
    """Rows that repeat, and draws of each kind, by the plain lookup and by the one that shuffles only rare values."""
    rows = spark.range(0, 60_000).select((F.col("id") % 50_000).alias("id"), F.lit("x").alias("other"))
    weights = ports_by_weight(spark, 5000)
    plain = weighted_assign(rows, "id", weights, "port", {"p": "one", "q": "two"})
    wanted = sorted(map(tuple, plain.collect()))
    assert "LeftAnti" not in plan_text(plain)
    spark.conf.set("flowloom.broadcastBytes", "300000")
    try:
        found = weighted_assign(rows, "id", weights, "port", {"p": "one", "q": "two"})
        assert "LeftAnti" in plan_text(found) and sorted(map(tuple, found.collect())) == wanted
    finally:
        spark.conf.unset("flowloom.broadcastBytes")


def test_flows_are_not_shuffled_when_lookups_are_small(spark, small):
    text = plan_text(make_flows(spark, small))
    above_rows = text.split("explode(sequence(((_piece")[0]
    assert "Exchange hashpartitioning" not in above_rows and "NestedLoop" not in text


def test_no_key_of_the_events_shows(spark, small):
    events = flow_inputs(spark, small)[0].withColumn("user_id", F.concat(F.lit("user-"), F.col("user_id").cast("string")))
    _, hosts, ports = flow_inputs(spark, small)
    flows = plan.flow_table(
        events, hosts, ports, "23/6/2020 11:00", "23/6/2020 13:00", 3000, "secret", favoured=(8, 44), fake=3, none=3
    )
    text = F.concat_ws(" ", *[F.col(c).cast("string") for c in flows.columns])
    assert flows.filter(text.contains("user-")).count() == 0


def test_flow_table_without_ports(spark, small):
    events, hosts, _ = flow_inputs(spark, small)
    flows = plan.flow_table(events, hosts, None, "23/6/2020 11:00", "23/6/2020 13:00", 3000, "s", fake=3, none=3)
    assert len(flows.columns) == 8 and "source_port" not in flows.columns


def test_too_thin_a_volume_is_an_error(spark, small):
    with pytest.raises(ValueError, match="fewer than"):
        make_flows(spark, small, min_per_minute=300)


def test_preview(spark, small):
    flows = make_flows(spark, small)
    preview = plan.flow_preview(flows)
    assert "TakeOrderedAndProject" in plan_text(preview)
    expected = sorted(flows.collect(), key=lambda r: (r["timestamp"], r["id"]))[:20]
    assert preview.collect() == expected


def test_flagged_flows(spark):
    rows = [("a.com", "xDGA.com"), (None, "b.com"), ("a.com", "b.com"), ("DGA.com.net", "b.com")]
    flows = spark.createDataFrame(rows, "source_domainName string, destination_domainName string")
    found = {tuple(r) for r in flag_generated(flows).collect()}
    assert found == {("a.com", "xDGA.com", None, "generated"), (None, "b.com", "missing", None)}


def test_enrich_looks_up_both_ends(spark):
    dim = spark.createDataFrame([(0, "ip0", "h0"), (1, "ip1", None)], "pos bigint, ip string, host string")
    pairs = spark.createDataFrame([(7, 1, 0)], "id bigint, src bigint, dst bigint")
    row = endpoint_enrich(pairs, dim).select("source_IP", "source_domainName", "destination_IP", "destination_domainName")
    assert tuple(row.first()) == ("ip1", None, "ip0", "h0")


def test_graph(spark):
    flows = spark.createDataFrame([("a", "b"), ("a", "b"), ("b", "a"), ("a", "c"), ("d", "d")], "s string, t string")
    edges = {tuple(r) for r in flow_edges(flows, "s", "t").collect()}
    assert edges == {("a", "b", 2), ("b", "a", 1), ("a", "c", 1), ("d", "d", 1)}
    nodes = {tuple(r) for r in flow_nodes(flows, "s", "t").collect()}
    assert nodes == {("a", 2, 1), ("b", 1, 1), ("c", 0, 1), ("d", 1, 1)}
