"""Attributes per row, drawn from the row's key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowloom.functions.draws import draw
from flowloom.operators.sizing import expand_counts, lookup_side

# 144 protocol numbers (0-143), a packet of 1,500 bytes, flows of 1,500.0 to
# 30,000.0 bytes in steps of 0.1.
PROTOCOLS = 144
PACKET_BYTES = 1500
LEAST_TENTHS, MOST_TENTHS = 15_000, 300_000
#: A value with at least this part of all tickets is heavy.
HEAVY = 1000
#: Listed values in a partition of a shuffled lookup.
LISTED = 1 << 18


def bucket_assign(rows: DataFrame, key: str, n: int = PROTOCOLS, salt: str = "protocol", into: str = "protocol") -> DataFrame:
    """Stable uniform bucket 0..n-1 for each row."""
    return rows.withColumn(into, draw(n, salt, key).cast("int"))


def size_fields(rows: DataFrame, key: str, amount: str | None = None) -> DataFrame:
    """Bytes with one decimal and the packets they fill; `amount` names a column to use as bytes instead."""
    if amount is None:
        tenths = draw(MOST_TENTHS - LEAST_TENTHS + 1, "bytes", key) + LEAST_TENTHS
        size = tenths / F.lit(10.0)
    else:
        size = F.col(amount).cast("double")
    return rows.withColumn("bytes", size).withColumn("packets", F.ceil(F.col("bytes") / PACKET_BYTES).cast("long"))


def weighted_assign(rows: DataFrame, key: str, weights: DataFrame, value: str, draws: dict[str, str]) -> DataFrame:
    """Values drawn by weight; `draws` names the salt of each new column, and each is a draw of its own.

    A row draws a ticket below the sum of weights; it belongs to the value with
    `hi - w <= ticket < hi`. The ticket range is cut into one to two cells per value, each value is
    listed in the cells it touches (at most three per value on average) and rows find it by an
    equi-join on the cell. Tickets are uniform over the cells, so a value that takes 40 % of the rows
    takes 40 % of the cells and no join key is hot.

    If there are too many values for a broadcast, those that hold a thousandth of the tickets or more, a thousand at most, are broadcast
    still, and only rows that draw another value are shuffled. Rows are then made once for each way their draws can fall, so
    pass narrow rows that are cheap to make and the same each time; add further columns afterwards.
    """
    count, tickets = weights.agg(F.count("*"), F.max("hi")).first()
    if not count:
        raise ValueError("the weight table is empty")
    lo = F.col("hi") - F.col("w")
    spans = weights.filter(F.col("w") > 0).select(lo.alias("_lo"), F.col("hi").alias("_hi"), F.col(value).alias("_value"))
    most = 3 * count + 1
    every, bits = _listed(spans, max(1, tickets // count), most)
    lookup, heavy = lookup_side(every, most), None
    if lookup is every:
        wide = max(1, tickets // HEAVY)
        common, common_bits = _listed(spans.filter(F.col("_hi") - F.col("_lo") >= wide), wide, 4 * HEAVY)
        heavy = lookup_side(common, 4 * HEAVY)
        # Where the session allows no broadcast, all values meet one join.
        heavy = None if heavy is common else heavy
        if heavy is not None:
            others, bits = _listed(spans.filter(F.col("_hi") - F.col("_lo") < wide), max(1, tickets // count), most)
            # Parts of bounded size are hashed, and rows need no sort.
            parts = max(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-most // LISTED))
            lookup = others.repartition(parts, "_cell").hint("shuffle_hash")
    for into, salt in draws.items():
        drawn = rows.withColumn("_ticket", draw(tickets, salt, key))
        columns = [*[F.col(f"`{c}`") for c in rows.columns], F.col("_value").alias(into)]
        if heavy is None:
            rows = _met(drawn, lookup, bits).select(*columns)
        else:
            rest = _met(drawn, heavy, common_bits, "left_anti").drop("_in_cell")
            rows = _met(drawn, heavy, common_bits).select(*columns).union(_met(rest, lookup, bits).select(*columns))
    return rows


def _listed(spans: DataFrame, width: int, most: int) -> tuple[DataFrame, int]:
    """The spans in each cell they touch, and the bits of a cell: 2**bits tickets, so that finding the cell of a ticket is a shift."""
    bits = width.bit_length() - 1
    first_cell = F.shiftright("_lo", bits)
    counted = spans.withColumn("_cells", F.shiftright(F.col("_hi") - 1, bits) - first_cell + 1)
    listed = expand_counts(counted, "_cells", "_nth", ["_lo"], most)
    return listed.select((first_cell + F.col("_nth") - 1).alias("_cell"), "_lo", "_hi", "_value"), bits


def _met(drawn: DataFrame, lookup: DataFrame, bits: int, how: str = "inner") -> DataFrame:
    """Rows with the span that their ticket lies in; or, `left_anti`, rows without one."""
    inside = (F.col("_ticket") >= F.col("_lo")) & (F.col("_ticket") < F.col("_hi"))
    return drawn.withColumn("_in_cell", F.shiftright("_ticket", bits)).join(lookup, (F.col("_in_cell") == F.col("_cell")) & inside, how)
