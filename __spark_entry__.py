
from __future__ import annotations

import os
import sys
from collections.abc import Callable
from datetime import datetime, timedelta
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import Column, DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from flowloom.functions.clock import ntz_literal  # noqa: E402
from flowloom.operators import (  # noqa: E402
    assign,
    columns,
    entities,
    fidelity,
    graph,
    heavyhitters,
    hiding,
    inference,
    intervals,
    lists,
    neighbours,
    positions,
    suppression,
    traffic,
)
from flowloom.plans import flows  # noqa: E402
from flowloom.sources import csvfiles, exports, foreign, keyedtable  # noqa: E402
from flowloom.sources.staging import fresh_path  # noqa: E402

try:
    from flowloom.llm import queries as llm
except ModuleNotFoundError as missing:
    # Only the absence of the subpackage itself is no error.
    if missing.name not in ("flowloom.llm", "corpus_pipeline"):
        raise
    llm = None

SECRET = "check"
FAVOURED = (8, 44)
CLASS_SIZE = 5
WINDOW = ("1/3/2024 10:30", "3/3/2024 12:30")
DAY = ("23/6/2020 11:00", "24/6/2020 11:00")
ROWS_PER_CSV_FILE = 1_000_000
BYTES_PER_CSV_FILE = 64 << 20


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _volume(events: DataFrame) -> int:
    """Rows to make: ten for each event."""
    return 10 * events.count()


def _port_text(part: DataFrame) -> DataFrame:
    """A column of port texts with gaps and ranges, made of the part keys."""
    key = F.col("p_partkey")
    span = F.concat_ws("-", key.cast("string"), (key + 3).cast("string"))
    raw = F.when(key % 7 == 0, None).when(key % 5 == 0, span).otherwise(key.cast("string"))
    return part.select(key.alias("pos"), raw.alias("raw"))


def _preferred(spark: SparkSession, sf_dir: str) -> DataFrame:
    ports = lists.port_clean(_port_text(_table(spark, sf_dir, "part")))
    return lists.preferred_first(ports, "port", "pos", FAVOURED)


def _weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flows.port_weights(_port_text(_table(spark, sf_dir, "part")), FAVOURED)


def _window(spark: SparkSession, sf_dir: str) -> DataFrame:
    return traffic.profile_window(traffic.minute_profile(_table(spark, sf_dir, "events")), *WINDOW)


def _allocation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return traffic.volume_allocation(_window(spark, sf_dir), _volume(_table(spark, sf_dir, "events")))


def _rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return traffic.row_expansion(_allocation(spark, sf_dir), _volume(_table(spark, sf_dir, "events")))


def _addresses(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, int]:
    events = _table(spark, sf_dir, "events")
    hosts = lists.host_list(_table(spark, sf_dir, "pages"))
    return flows.known_addresses(events, "user_id", hosts, SECRET, CLASS_SIZE, CLASS_SIZE)


def _flows(spark: SparkSession, sf_dir: str, with_ports: bool = True) -> DataFrame:
    events = _table(spark, sf_dir, "events")
    hosts = lists.host_list(_table(spark, sf_dir, "pages"))
    ports = _port_text(_table(spark, sf_dir, "part")) if with_ports else None
    classes = {"fake": CLASS_SIZE, "none": CLASS_SIZE}
    return flows.flow_rows(events, hosts, ports, *DAY, _volume(events), SECRET, favoured=FAVOURED, **classes)


def _supply(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "lineitem").select(
        F.concat(F.lit("s"), F.col("l_suppkey").cast("string")).alias("supplier"),
        F.concat(F.lit("p"), F.col("l_partkey").cast("string")).alias("part"),
    )


def csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = _table(spark, sf_dir, "events")
    files = max(2, events.count() // ROWS_PER_CSV_FILE)
    return csvfiles.csv_roundtrip(events, fresh_path(spark, "csv"), files)


def csv_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Long prose with line breaks."""
    return csvfiles.csv_roundtrip(_table(spark, sf_dir, "documents"), fresh_path(spark, "csv"))


def _some_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events, some of which have no time."""
    timed = F.when(F.col("event_id") % 10 > 0, F.col("ts"))
    return _table(spark, sf_dir, "events").withColumn("ts", timed)


def export_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row written by window, and read back with its label."""
    events, path = _some_times(spark, sf_dir), fresh_path(spark, "windows")
    exports.export_windows(events, path)
    return exports.read_windows(spark, path, events.schema)


def export_manifest_no_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exports.export_manifest(_some_times(spark, sf_dir))


def port_clean_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ports from a foreign CSV file, read as text in the order of its lines."""
    path = fresh_path(spark, "ports")
    ports = _port_text(_table(spark, sf_dir, "part")).repartitionByRange("pos").sortWithinPartitions("pos")
    ports.select(F.col("raw").alias("Port Number"), F.lit("tcp").alias("Protocol")).write.option("header", True).csv(path)
    lines = csvfiles.read_text_columns_in_order(spark, path, "Port Number")
    return lists.port_clean(lines.withColumnRenamed("Port Number", "raw"))


def csv_foreign_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents written as others write them, line breaks inside quotes, and read in byte ranges."""
    docs, path = _table(spark, sf_dir, "documents").select("doc_id", "lang", "text", "n_chars"), fresh_path(spark, "foreign")
    size = docs.agg(F.coalesce(F.sum(F.octet_length("text").cast("long")), F.lit(0))).first()[0]
    docs.repartition(max(3, -(-size // BYTES_PER_CSV_FILE))).write.options(header=True, escape='"', quoteAll=True).csv(path)
    rows = foreign.read_foreign(spark, path)
    return columns.typed_projection(rows, "doc_id bigint, lang string, text string, n_chars bigint")


def _event_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as texts, with some columns that fit a narrow type but for a few values."""
    events, key = _table(spark, sf_dir, "events"), F.col("event_id")
    cents = F.col("value").cast("decimal(18,2)").cast("string")
    texts = {
        "event_id": key.cast("string"),
        "long_id": (key * 1_000_000_007).cast("string"),
        "ts": F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS"),
        "day": F.when(key % 7 > 0, F.date_format("ts", "yyyy-MM-dd")),
        "cents": cents,
        "kind": F.col("event_type"),
        "mostly_number": F.when(key % 1000 == 999, "n/a").otherwise(key.cast("string")),
        "mostly_day": F.when(key % 500 == 499, "2024-02-30").otherwise(F.date_format("ts", "yyyy-MM-dd")),
        "scientific": F.concat(cents, F.lit("e"), (key % 9).cast("string")),
        "nothing": F.lit(None).cast("string"),
    }
    return events.select(*[c.alias(name) for name, c in texts.items()])


def inferred_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inference.inferred_types(_event_texts(spark, sf_dir))


def distinct_addresses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hiding.distinct_addresses(_table(spark, sf_dir, "events"), "user_id", SECRET)


def hidden_prefixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Addresses made of customer and order keys, so that many share prefixes."""
    orders = _table(spark, sf_dir, "orders").select("o_custkey", (F.col("o_orderkey") % 4).alias("host")).distinct()
    number = (F.col("o_custkey") * 2654435761 % (1 << 30) * 4 + F.col("host")).cast("long")
    return hiding.hidden_prefixes(orders.select(number.alias("number")).distinct(), "number", SECRET)


def top_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The twenty ends of flows that most line items have, suppliers or parts."""
    ends = _supply(spark, sf_dir).select(F.explode(F.array("supplier", "part")).alias("node"))
    return heavyhitters.top_keys(ends, ["node"], 20)


def events_in_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For each purchase, the events and users in the minutes behind it; as many minutes as its value says."""
    at = F.expr("timestampdiff(MICROSECOND, timestamp_ntz'1970-01-01 00:00:00', ts)")
    events = _table(spark, sf_dir, "events").withColumn("at", at)
    minutes = F.ceil("value").cast("long")
    windows = events.filter("event_type = 'purchase'").select("event_id", "at", (F.col("at") + minutes * 60_000_000).alias("behind"))
    found = intervals.overlap_counts(events, "at", "user_id", windows, ("at", "behind"), "event_id")
    return found.toDF("window_id", "n_events", "n_users")


def _month(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, Column]:
    lines = _table(spark, sf_dir, "lineitem").select("l_suppkey", "l_partkey", "l_shipdate")
    return lines, F.year("l_shipdate") * 12 + F.month("l_shipdate")


def supplier_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct parts of each supplier in each quarter of a year that ends with a month."""
    lines, month = _month(spark, sf_dir)
    return neighbours.window_neighbours(lines, "l_suppkey", "l_partkey", month, 3)


def flow_fidelity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items of even orders released in place of all: how far their distributions are from the originals."""
    lines = _table(spark, sf_dir, "lineitem")
    hour = (F.year("l_shipdate") * 366 + F.dayofyear("l_shipdate")).alias("day")
    rows = lines.select("l_orderkey", "l_quantity", "l_extendedprice", "l_discount", F.col("l_partkey").alias("part"), hour)
    released = rows.filter("l_orderkey % 2 = 0")
    return fidelity.fidelity(rows, released, ["l_quantity", "l_extendedprice", "l_discount", "part", "day"])


def released_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items by supplier, time and amount, each as coarse as it takes for groups of ten, and the groups."""
    lines = _table(spark, sf_dir, "lineitem")
    year, price = F.year("l_shipdate"), F.col("l_extendedprice")
    nothing = F.lit("*")
    levels = {
        "supplier": [F.concat(F.lit("s"), F.col("l_suppkey")), F.concat(F.lit("s"), F.col("l_suppkey") % 10), nothing],
        "time": [F.date_format("l_shipdate", "yyyy-MM-dd"), F.date_format("l_shipdate", "yyyy-MM"), year.cast("string"), nothing],
        "amount": [*[F.floor(price / step).cast("string") for step in (1000, 10_000, 100_000)], nothing],
    }
    rows = suppression.generalised(lines.select("l_suppkey", "l_shipdate", "l_extendedprice"), levels, 10)
    return rows.groupBy(*levels).agg(F.count("*").alias("n"))


def keyed_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hosts with their first page and last URL, from three batches of pages, the last ones first."""
    pages = _table(spark, sf_dir, "pages").select("page_id", "url", lists.url_host("url").alias("host"))
    table = keyedtable.KeyedTable(spark, fresh_path(spark, "hosts"), "host", "url", "page_id", ranges=8)
    for k in (2, 0, 1):
        table.merge(pages.filter(F.col("page_id") % 3 == k), f"batch {k}")
    return table.rows().withColumnRenamed("page_id", "pos")


def export_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exports.export_manifest(_table(spark, sf_dir, "events"))


def typed_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = _table(spark, sf_dir, "customer")
    balance = F.when(F.col("c_nationkey") % 5 == 0, "n/a").otherwise(F.col("c_acctbal").cast("string"))
    raw = customer.withColumn("c_acctbal", balance).select([F.col(c).cast("string") for c in customer.columns])
    # A market segment is no number, so as bigint it is NULL.
    schema = "c_custkey bigint, c_acctbal double, c_nationkey int, c_name string, c_mktsegment bigint"
    return columns.typed_projection(raw, schema)


def positional_zip(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = _table(spark, sf_dir, "events")
    by_id = events.select("event_id", "user_id")
    by_value = events.select(F.col("event_id").alias("value_event_id"), "value")
    return positions.positional_zip(by_id, ["event_id"], by_value, ["value", "value_event_id"])


def host_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lists.host_list(_table(spark, sf_dir, "pages"))


def first_seen_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lists.first_seen_distinct(_table(spark, sf_dir, "part"), "p_brand", "p_partkey")


def port_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lists.port_clean(_port_text(_table(spark, sf_dir, "part")))


def keyed_last_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _table(spark, sf_dir, "pages").select("page_id", "url", lists.url_host("url").alias("host"))
    return lists.keyed_last_wins(pages, "host", "url", "page_id")


def minute_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return traffic.minute_profile(_table(spark, sf_dir, "events"))


def volume_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    return traffic.volume_total(_allocation(spark, sf_dir), _volume(_table(spark, sf_dir, "events")))


def volume_allocation_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    total = 3 * _table(spark, sf_dir, "events").count() + 7
    return traffic.volume_allocation_exact(_window(spark, sf_dir), total)


def density_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    return traffic.density_check(_table(spark, sf_dir, "events"), min_per_minute=None)


def minute_jitter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return traffic.minute_jitter(_rows(spark, sf_dir))


def expected_vs_actual(spark: SparkSession, sf_dir: str) -> DataFrame:
    return traffic.expected_vs_actual(_window(spark, sf_dir), _allocation(spark, sf_dir))


def expected_vs_counted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The profile of the first half of the days, laid over the other half, against the events counted there."""
    events = _table(spark, sf_dir, "events")
    first, last = events.agg(F.min("ts"), F.max("ts")).first()
    day = timedelta(days=1)
    begin, end = datetime(first.year, first.month, first.day), datetime(last.year, last.month, last.day) + day
    middle = begin + (end - begin) // day // 2 * day
    profile = traffic.minute_profile(events.filter(F.col("ts") < ntz_literal(middle)))
    window = traffic.profile_window(profile, middle, end)
    return traffic.expected_vs_actual(window, traffic.minute_counts(events, middle, end))


def event_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = _table(spark, sf_dir, "events").select("event_id", "user_id", "ts")
    return traffic.order_in_day(events, "ts", "event_id").drop("ts")


def tick_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return traffic.tick_rollup(_table(spark, sf_dir, "events"))


def address_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    return entities.address_dim(_table(spark, sf_dir, "events"), "user_id", SECRET)


def domain_assign(spark: SparkSession, sf_dir: str) -> DataFrame:
    return entities.domain_assign(address_dim(spark, sf_dir), host_list(spark, sf_dir))


def domain_class(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _addresses(spark, sf_dir)[0]


def flag_generated(spark: SparkSession, sf_dir: str) -> DataFrame:
    return entities.flag_generated(_flows(spark, sf_dir))


def endpoint_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = _table(spark, sf_dir, "events")
    users = events.select("user_id").filter("user_id is not null").distinct().count()
    return entities.endpoint_pairs(events.select("event_id"), "event_id", users)


def endpoint_enrich(spark: SparkSession, sf_dir: str) -> DataFrame:
    dim, count = _addresses(spark, sf_dir)
    pairs = entities.endpoint_pairs(_table(spark, sf_dir, "events").select("event_id"), "event_id", count)
    return entities.endpoint_enrich(pairs, dim).drop("src", "dst")


def bucket_assign(spark: SparkSession, sf_dir: str) -> DataFrame:
    return assign.bucket_assign(_table(spark, sf_dir, "events").select("event_id"), "event_id")


def size_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    return assign.size_fields(_table(spark, sf_dir, "events").select("event_id"), "event_id")


def size_fields_amount(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = _table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice")
    return assign.size_fields(lines, "l_orderkey", amount="l_extendedprice").drop("l_extendedprice")


def weighted_assign(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = _table(spark, sf_dir, "events").select("event_id", "user_id")
    return assign.weighted_assign(events, "event_id", _weights(spark, sf_dir), "port", flows.PORT_DRAWS)


def flow_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _flows(spark, sf_dir).select(*flows.FLOW_COLUMNS)


def flow_preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flows.flow_preview(_flows(spark, sf_dir))


def flow_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graph.flow_edges(_flows(spark, sf_dir, with_ports=False))


def flow_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graph.flow_nodes(_flows(spark, sf_dir, with_ports=False))


def flow_edges_supply(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counted under the raw keys; texts are made for each edge, not for each row."""
    edges = graph.flow_edges(_table(spark, sf_dir, "lineitem"), "l_suppkey", "l_partkey")
    return edges.select(F.concat(F.lit("s"), "src").alias("src"), F.concat(F.lit("p"), "dst").alias("dst"), "n")


def flow_nodes_supply(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graph.flow_nodes(flow_edges_supply(spark, sf_dir), "src", "dst", distinct=True)


def _keyed(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, Column, Column]:
    """Line items with the keys of their supplier and part."""
    lines = _table(spark, sf_dir, "lineitem").select("l_suppkey", "l_partkey", "l_extendedprice", "l_shipdate")
    supplier = F.concat(F.lit("s"), F.col("l_suppkey").cast("string"))
    return lines, supplier, F.concat(F.lit("p"), F.col("l_partkey").cast("string"))


def supply_flows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A flow for each line item, from its supplier to its part, with keyed addresses in place of both."""
    return flows.keyed_flows(*_keyed(spark, sf_dir), "l_extendedprice", "l_shipdate", SECRET)


def supply_flow_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flows.keyed_edges(*_keyed(spark, sf_dir), SECRET)


def supply_flow_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flows.keyed_nodes(*_keyed(spark, sf_dir), SECRET)


def supply_flow_preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flows.flow_preview(supply_flows(spark, sf_dir))


def entry(spark: SparkSession) -> DataFrame:
    """The flows of the smallest test tables, or of the folder that ENTRY_SF_DIR names."""
    return supply_flows(spark, os.environ.get("ENTRY_SF_DIR", "/root/testdata/sf0.001"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "csv_roundtrip": csv_roundtrip,
        "export_manifest": export_manifest,
        "typed_projection": typed_projection,
        "positional_zip": positional_zip,
        "host_list": host_list,
        "first_seen_distinct": first_seen_distinct,
        "port_clean": port_clean,
        "preferred_first": _preferred,
        "weight_table": _weights,
        "keyed_last_wins": keyed_last_wins,
        "minute_profile": minute_profile,
        "profile_window": _window,
        "volume_allocation": _allocation,
        "volume_total": volume_total,
        "volume_allocation_exact": volume_allocation_exact,
        "density_check": density_check,
        "row_expansion": _rows,
        "minute_jitter": minute_jitter,
        "expected_vs_actual": expected_vs_actual,
        "tick_rollup": tick_rollup,
        "address_dim": address_dim,
        "domain_assign": domain_assign,
        "domain_class": domain_class,
        "flag_generated": flag_generated,
        "endpoint_pairs": endpoint_pairs,
        "endpoint_enrich": endpoint_enrich,
        "bucket_assign": bucket_assign,
        "size_fields": size_fields,
        "size_fields_amount": size_fields_amount,
        "weighted_assign": weighted_assign,
        "flow_table": flow_table,
        "flow_preview": flow_preview,
        "flow_edges": flow_edges,
        "flow_nodes": flow_nodes,
        "flow_edges_supply": flow_edges_supply,
        "flow_nodes_supply": flow_nodes_supply,
        "csv_documents": csv_documents,
        "export_roundtrip": export_roundtrip,
        "export_manifest_no_time": export_manifest_no_time,
        "port_clean_csv": port_clean_csv,
        "expected_vs_counted": expected_vs_counted,
        "event_order": event_order,
        "supply_flows": supply_flows,
        "supply_flow_edges": supply_flow_edges,
        "supply_flow_nodes": supply_flow_nodes,
        "supply_flow_preview": supply_flow_preview,
        "csv_foreign_records": csv_foreign_records,
        "inferred_types": inferred_types,
        "distinct_addresses": distinct_addresses,
        "hidden_prefixes": hidden_prefixes,
        "top_nodes": top_nodes,
        "events_in_windows": events_in_windows,
        "supplier_parts": supplier_parts,
        "flow_fidelity": flow_fidelity,
        "keyed_batches": keyed_batches,
        "released_groups": released_groups,
        **(llm.queries() if llm else {}),
    }


def oracle_sql() -> dict[str, str]:
    """The same queries as DuckDB text; column names match. Only this needs the test packages."""
    import flow_oracle

    return {**flow_oracle.oracle_sql(), **(llm.oracle_sql() if llm else {})}
