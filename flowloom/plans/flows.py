"""The flow table: rows that follow the traffic profile of an event table but show none of its identifiers."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from flowloom.functions.addresses import dotted_quad, keyed_address, with_secret
from flowloom.functions.clock import window_minutes
from flowloom.operators.assign import bucket_assign, size_fields, weighted_assign
from flowloom.operators.entities import (
    address_pool,
    domain_assign,
    domain_class,
    endpoint_enrich,
    endpoint_pairs,
)
from flowloom.operators.graph import flow_nodes
from flowloom.operators.lists import port_clean, preferred_list, weight_table
from flowloom.operators.traffic import (
    jittered,
    minute_profile,
    profile_window,
    row_expansion,
    volume_allocation,
)
from flowloom.sources.staging import stage

# Fixed columns and their order.
FLOW_COLUMNS = [
    "bytes",
    "packets",
    "protocol",
    "source_IP",
    "source_domainName",
    "source_port",
    "destination_IP",
    "destination_domainName",
    "destination_port",
    "timestamp",
]

# Salts of the two port draws.
PORT_DRAWS = {"source_port": "source port", "destination_port": "destination port"}


def known_addresses(
    events: DataFrame, key: str, hosts: DataFrame, secret: str, fake: int = 10, none: int = 10
) -> tuple[DataFrame, int]:
    """Dimension of addresses with their domains, from the entity keys of the events; and its size."""
    pool, count = address_pool(events, key, secret)
    return domain_class(stage(domain_assign(pool, hosts), "addresses"), fake, none, count), count


def port_weights(ports: DataFrame, favoured: Sequence[int], raw: str = "raw", pos: str = "pos") -> DataFrame:
    """Weights for the ports among raw texts, the favoured ones 40 % each if there are two."""
    listed, count = preferred_list(port_clean(ports, raw, pos), "port", "pos", favoured)
    return weight_table(listed, "port", len(favoured), count=count)


def _side_by_side(spark: SparkSession, *steps: Callable) -> list:
    """Results of steps that do not need each other; their Spark jobs share the cluster."""
    with ThreadPoolExecutor(len(steps)) as pool:
        return [done.result() for done in [pool.submit(inheritable_thread_target(spark)(step)) for step in steps]]


def flow_rows(
    events: DataFrame,
    hosts: DataFrame,
    ports: DataFrame | None,
    start: str | datetime,
    end: str | datetime,
    total: int,
    secret: str,
    favoured: Sequence[int] = (80, 443),
    ts: str = "ts",
    key: str = "user_id",
    fake: int = 10,
    none: int = 10,
    min_per_minute: float | None = None,
) -> DataFrame:
    """The flow table with the id of each row.

    The profile, the addresses and the ports are small results of large scans; they are computed
    side by side and staged, so the flows themselves are made in one pass. Every attribute is computed from the row id, and the
    lookups are broadcast joins as long as their measured size allows it, so no flow is shuffled. Of ports too many for that the
    common ones are broadcast; flows with others are shuffled as ids, before they get their other columns.

    Without `ports` the two port columns are left out. `min_per_minute` makes a volume too thin
    for the window an error.
    """
    if min_per_minute is not None and total / window_minutes(start, end) < min_per_minute:
        raise ValueError(f"{total} rows are fewer than {min_per_minute} per minute from {start} to {end}")
    profile, (addresses, count), weights = _side_by_side(
        events.sparkSession,
        lambda: stage(minute_profile(events, ts), "profile"),
        lambda: known_addresses(events, key, hosts, secret, fake, none),
        lambda: None if ports is None else port_weights(ports, favoured),
    )
    allocation = volume_allocation(profile_window(profile, start, end), total)

    # Lookups too large for a broadcast shuffle rows, so those meet them while they are narrow.
    rows = row_expansion(allocation, total).select("id", "minute_ts")
    if weights is not None:
        rows = weighted_assign(rows, "id", weights, "port", PORT_DRAWS)
    rows = endpoint_enrich(endpoint_pairs(rows, "id", count), addresses)
    rows = size_fields(bucket_assign(rows.withColumn("timestamp", jittered()), "id"), "id")
    return rows.select("id", *[c for c in FLOW_COLUMNS if c in rows.columns])


def flow_table(*args, **kwargs) -> DataFrame:
    """The columns of a flow in their fixed order; arguments as for `flow_rows`."""
    return flow_rows(*args, **kwargs).drop("id")


def keyed_flows(
    rows: DataFrame, source: Column, destination: Column, amount: str, ts: str, secret: str
) -> DataFrame:
    """One flow per row of an existing table, with its identifiers hidden: keyed addresses in place of both keys.

    Bytes and the packets they fill come from an amount, the time is kept. Everything is computed from the row itself, so
    nothing is joined or shuffled, and no raw key is left. Keys of two kinds need prefixes, or equal numbers would get one address.
    A row without a key has no address there.
    """
    sized = with_secret(size_fields(rows, "", amount=amount), secret)
    return sized.select(
        "bytes",
        "packets",
        dotted_quad(keyed_address(source, F.col("_secret"))).alias("source_IP"),
        dotted_quad(keyed_address(destination, F.col("_secret"))).alias("destination_IP"),
        F.col(ts).alias("timestamp"),
    )


def keyed_edges(rows: DataFrame, source: Column, destination: Column, secret: str) -> DataFrame:
    """The edges of `keyed_flows` with their numbers of flows, counted under the raw keys: each edge is hidden once, not each row."""
    counted = rows.groupBy(source.alias("_from"), destination.alias("_to")).agg(F.count("*").alias("_n"))
    number = [keyed_address(c, F.col("_secret")).alias(c) for c in ("_from", "_to")]
    # Keys that share an address become one.
    edges = with_secret(counted, secret).select(*number, "_n").groupBy("_from", "_to").agg(F.sum("_n").alias("n"))
    return edges.select(dotted_quad("_from").alias("src"), dotted_quad("_to").alias("dst"), "n")


def keyed_nodes(rows: DataFrame, source: Column, destination: Column, secret: str) -> DataFrame:
    """The nodes of `keyed_flows`, from its edges."""
    return flow_nodes(keyed_edges(rows, source, destination, secret), "src", "dst", distinct=True)


def flow_preview(flows: DataFrame, n: int = 20) -> DataFrame:
    """The first n flows by time (then by id, if the flows carry it)."""
    tie = ["id"] if "id" in flows.columns else [c for c in flows.columns if c != "timestamp"]
    return flows.orderBy("timestamp", *tie).limit(n)
