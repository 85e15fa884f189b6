"""Pseudonymous addresses that never collide, and addresses that keep their common prefixes.

Keys derived from the secret are a broadcast table of one row, so no plan, event log or error message holds them.
"""

from __future__ import annotations

import hashlib
import hmac

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowloom.functions.addresses import HIGHEST_ADDRESS, dotted_quad, with_secret
from flowloom.operators.positions import numbered

ROUNDS = 8
_MARK, _HALF = "_secret", 0xFFFF


def round_keys(secret: str, purpose: str, count: int = ROUNDS) -> list[str]:
    """Keys for several uses of one secret; none tells another."""
    return [hmac.new(secret.encode(), f"{purpose} {k}".encode(), hashlib.sha256).hexdigest() for k in range(count)]


def _round(half: Column, key: Column) -> Column:
    """16 bits of a keyed digest."""
    digest = F.sha2(F.concat(key, F.lit(":"), half.cast("string")), 256)
    return F.conv(F.substring(digest, 1, 4), 16, 10).cast("long")


def _feistel(number: Column, keys: Column, back: bool = False) -> Column:
    """A keyed bijection of 0 ... 2**32 - 1: balanced rounds, folded so that each is computed once."""
    both = F.struct(F.shiftright(number, 16).alias("l"), number.bitwiseAND(F.lit(_HALF)).alias("r"))

    def forth(s: Column, key: Column) -> Column:
        return F.struct(s["r"].alias("l"), s["l"].bitwiseXOR(_round(s["r"], key)).alias("r"))

    def undo(s: Column, key: Column) -> Column:
        return F.struct(s["r"].bitwiseXOR(_round(s["l"], key)).alias("l"), s["l"].alias("r"))

    order = F.reverse(keys) if back else keys
    joined = F.aggregate(order, both, undo if back else forth)
    return joined["l"] * F.lit(1 << 16).cast("long") + joined["r"]


def hidden_number(number: Column, keys: Column) -> Column:
    """A keyed bijection of 1 ... 2**32 - 1. The one number that comes out as 0 walks on to where 0 goes."""
    once = _feistel(number, keys)
    return F.when(once != 0, once).otherwise(_feistel(F.lit(0).cast("long"), keys))


def shown_number(number: Column, keys: Column) -> Column:
    """The number that `hidden_number` has hidden."""
    once = _feistel(number, keys, True)
    return F.when(once != 0, once).otherwise(_feistel(F.lit(0).cast("long"), keys, True))


def distinct_addresses(df: DataFrame, key: str, secret: str) -> DataFrame:
    """(pos, key, ip_number, ip): an address for each distinct key, never the same for two.

    Keys are ranked (one shuffle to make them distinct, one by ranges) and ranks are permuted by a keyed bijection, so addresses
    differ by construction for up to 2**32 - 1 keys; more are an error. A null key has no address.
    """
    keys = df.select(F.col(f"`{key}`").alias("key")).filter(F.col("key").isNotNull()).distinct()
    placed, count = numbered(keys, "key")
    if count > HIGHEST_ADDRESS:
        raise ValueError(f"{count} keys are more than there are addresses")
    number = hidden_number(F.col("pos") + 1, F.col(_MARK))
    rows = with_secret(placed, round_keys(secret, "rank")).withColumn("ip_number", number)
    return rows.select("pos", "key", "ip_number", dotted_quad("ip_number").alias("ip"))


def shown_positions(addresses: DataFrame, secret: str, number: str = "ip_number") -> DataFrame:
    """The rows with `pos`, the rank that `distinct_addresses` hid in each address number."""
    rows = with_secret(addresses, round_keys(secret, "rank"))
    return rows.withColumn("pos", shown_number(F.col(f"`{number}`"), F.col(_MARK)) - 1).drop(_MARK)


def _bits(number: Column, keys: Column, back: bool) -> Column:
    """Each bit is turned or not by a keyed digest of the bits before it, as they are in the open."""
    begin = F.struct(F.lit("").alias("before"), F.lit(0).cast("long").alias("out"))

    def step(s: Column, k: Column) -> Column:
        bit = F.call_function("shiftright", number, k.cast("int")).bitwiseAND(F.lit(1)).cast("long")
        digest = F.sha2(F.concat(F.get(keys, F.lit(0)), F.lit(":"), s["before"]), 256)
        turned = bit.bitwiseXOR(F.conv(F.substring(digest, 1, 1), 16, 10).cast("long").bitwiseAND(F.lit(1)))
        plain = turned if back else bit
        return F.struct(F.concat(s["before"], plain.cast("string")).alias("before"), (s["out"] * 2 + turned).alias("out"))

    return F.aggregate(F.sequence(F.lit(31), F.lit(0)), begin, step)["out"]


def hidden_prefixes(df: DataFrame, number: str, secret: str, into: str = "hidden", back: bool = False) -> DataFrame:
    """The rows with their address numbers hidden so that two share as many leading bits as before, and no more.

    Nothing is shuffled; apply it to distinct addresses, as it costs 32 digests each. `back` shows hidden numbers again.
    """
    rows = with_secret(df, round_keys(secret, "prefix", 1))
    return rows.withColumn(into, _bits(F.col(f"`{number}`"), F.col(_MARK), back)).drop(_MARK)
