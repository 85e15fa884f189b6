"""IPv4 numbers and their text form."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed value: addresses are drawn from 1 to 2**32 - 1.
HIGHEST_ADDRESS = 2**32 - 1


def keyed_address(key: Column | str, secret: Column) -> Column:
    """Address number for a key: 52 bits of a secret-keyed SHA-256, folded into 1..2**32-1.

    Without the secret the number cannot be tied back to the key by trying all keys. It is a column (see `with_secret`), since
    a literal would stand in plans and logs.
    """
    text = (F.col(key) if isinstance(key, str) else key).cast("string")
    digest = F.sha2(F.concat(secret, F.lit(":"), text), 256)
    number = F.conv(F.substring(digest, 1, 13), 16, 10).cast("long")
    return number % F.lit(HIGHEST_ADDRESS).cast("long") + F.lit(1)


def dotted_quad(number: Column | str) -> Column:
    """1 -> 0.0.0.1, 4294967295 -> 255.255.255.255."""
    octets = [F.shiftright(number, shift).bitwiseAND(F.lit(255)).cast("string") for shift in (24, 16, 8, 0)]
    return F.concat_ws(".", *octets)


def with_secret(df: DataFrame, secret: str | list[str], into: str = "_secret") -> DataFrame:
    """Each row beside a secret text or list of texts, in a column of its own.

    The secret is a broadcast table of one row, joined on a value that all rows have, so no plan, event log or error message holds it.
    """
    spark = SparkSession.getActiveSession() or df.sparkSession
    kind = "string" if isinstance(secret, str) else "array<string>"
    table = spark.createDataFrame([(0, secret)], f"_one int, {into} {kind}")
    # Nothing that the optimizer could fold, or the join would have no key.
    one = F.pmod(F.hash(*[F.col(f"`{c}`") for c in df.columns[:1]]), F.lit(1))
    return df.withColumn("_one", one).join(F.broadcast(table), "_one").drop("_one")
