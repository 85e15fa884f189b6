"""Addresses and domains for entities, and both ends of a flow."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from flowloom.functions.addresses import dotted_quad, keyed_address, with_secret
from flowloom.functions.draws import draw, label
from flowloom.operators.positions import numbered, with_position
from flowloom.operators.sizing import lookup_side

# What a generated domain ends in, and the three classes.
GENERATED_ENDING = "DGA.com"
KNOWN, GENERATED, MISSING = "known", "generated", "missing"


def entity_addresses(df: DataFrame, key: str, secret: str) -> DataFrame:
    """Every distinct key with its address number."""
    keys = df.select(F.col(key).alias("key")).filter(F.col("key").isNotNull()).distinct()
    return with_secret(keys, secret).withColumn("ip_number", keyed_address("key", F.col("_secret"))).drop("_secret")


def address_dim(df: DataFrame, key: str, secret: str) -> DataFrame:
    """One pseudonymous IPv4 address per distinct key, positions in key order.

    `same_ip` counts the keys that got the same address; 1 means no collision.
    """
    same_ip = F.count("*").over(Window.partitionBy("ip_number"))
    placed = with_position(entity_addresses(df, key, secret).withColumn("same_ip", same_ip), "key")
    return placed.select("pos", "key", "ip_number", dotted_quad("ip_number").alias("ip"), "same_ip")


def address_pool(df: DataFrame, key: str, secret: str) -> tuple[DataFrame, int]:
    """Every address once, and how many there are: keys that share one are one entry, at the place of the first of them.

    `same_ip` counts the keys of an entry; the sum of `same_ip - 1` is the number of keys that were merged away.
    """
    addresses = entity_addresses(df, key, secret).groupBy("ip_number")
    placed, count = numbered(addresses.agg(F.min("key").alias("_first"), F.count("*").alias("same_ip")), "_first")
    return placed.select("pos", "ip_number", dotted_quad("ip_number").alias("ip"), "same_ip"), count


def domain_assign(addresses: DataFrame, hosts: DataFrame) -> DataFrame:
    """Give each address a host drawn uniformly, with replacement, from the list of hosts."""
    placed, count = numbered(hosts.select("host"), "host", name="_host_pos")
    if count == 0:
        raise ValueError("the list of hosts is empty")
    drawn = addresses.withColumn("_host_pos", draw(count, "host", "ip_number"))
    return drawn.join(lookup_side(placed), "_host_pos").drop("_host_pos")


def domain_class(dim: DataFrame, fake: int = 10, none: int = 10, count: int | None = None) -> DataFrame:
    """The first `fake` addresses get a generated domain, the next `none` get no domain, the rest keep theirs.

    Fewer addresses than that are an error; `count` is their number, if the caller knows it.
    """
    if count is None:
        count = dim.count()
    if fake + none > count:
        raise ValueError(f"{fake} generated and {none} missing domains are more than the {count} addresses")
    kind = F.when(F.col("pos") < fake, GENERATED).when(F.col("pos") < fake + none, MISSING).otherwise(KNOWN)
    host = (
        F.when(F.col("class") == GENERATED, F.concat(label("label", "ip_number"), F.lit(GENERATED_ENDING)))
        .when(F.col("class") == KNOWN, F.col("host"))
    )
    return dim.withColumn("class", kind).withColumn("host", host)


def flag_generated(flows: DataFrame) -> DataFrame:
    """Flows with a generated or missing domain at either end, and which end it is."""

    def flag(host: str):
        return F.when(F.col(host).isNull(), MISSING).when(F.col(host).endswith(GENERATED_ENDING), GENERATED)

    flagged = flows.select(
        "*",
        flag("source_domainName").alias("source_flag"),
        flag("destination_domainName").alias("destination_flag"),
    )
    return flagged.filter(F.col("source_flag").isNotNull() | F.col("destination_flag").isNotNull())


def endpoint_pairs(rows: DataFrame, key: str, n: int) -> DataFrame:
    """Two different positions below n per row, uniform over all ordered pairs, without a redraw."""
    if n < 2:
        raise ValueError("two different endpoints need at least two addresses")
    ahead = F.col("src") + draw(n - 1, "destination", key) + 1
    wrapped = F.when(ahead < n, ahead).otherwise(ahead - n)
    return rows.withColumn("src", draw(n, "source", key)).withColumn("dst", wrapped)


def endpoint_enrich(pairs: DataFrame, dim: DataFrame) -> DataFrame:
    """Address and domain for the source and the destination position of each row."""
    side = dim.select("pos", "ip", "host")
    lookup = lookup_side(side)
    source = lookup.toDF("src", "source_IP", "source_domainName")
    destination = lookup.toDF("dst", "destination_IP", "destination_domainName")
    return pairs.join(source, "src").join(destination, "dst")
