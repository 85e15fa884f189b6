"""Blocked Bloom filters as tables, and joins that shuffle only the rows a filter lets through.

A filter has blocks of 512 bits: a hash of the key picks the block, and one bit in each of its eight words. It is a table with
a row for each block, made by a bitwise aggregation. Its size is set beforehand, at most `MAX_BLOCKS` rows however many keys
there are, so it can be broadcast; more keys only let more false positives through, which an exact join removes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_WORDS, _BITS_A_KEY = 8, 16
#: 16 MB of bits.
MAX_BLOCKS = 1 << 18


def _bits(key: Column) -> list[Column]:
    """The bit set in each word of the key's block."""
    marks, one = F.xxhash64(F.lit("bits"), key), F.lit(1).cast("long")
    places = [F.shiftright(marks, 6 * j).bitwiseAND(F.lit(63)).cast("int") for j in range(_WORDS)]
    return [F.call_function("shiftleft", one, place) for place in places]


def _block(key: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(F.lit("block"), key), F.lit(blocks)).cast("int")


def bloom_filter(keys: DataFrame, column: str, most: int = MAX_BLOCKS) -> tuple[DataFrame, int]:
    """(block, w0 ... w7) and the number of blocks, never more than `most`."""
    blocks = max(1, min(most, -(-keys.count() * _BITS_A_KEY // (64 * _WORDS))))
    words = [F.bit_or(bit).alias(f"w{j}") for j, bit in enumerate(_bits(F.col(column)))]
    return keys.groupBy(_block(F.col(column), blocks).alias("block")).agg(*words), blocks


def fresh_names(rows: DataFrame, *names: str) -> list[str]:
    """Names like these that are no columns of `rows`, in whatever case."""
    tail, taken = "", {c.lower() for c in rows.columns}
    while any(name + tail in taken for name in names):
        tail += "_"
    return [name + tail for name in names]


def probed(rows: DataFrame, key: Column, keys: DataFrame, column: str, most: int = MAX_BLOCKS) -> tuple[DataFrame, DataFrame]:
    """The rows whose key may be among `keys`, and those whose key is not; a null key is not."""
    table, blocks = bloom_filter(keys, column, most)
    block, hit, *words = fresh_names(rows, "block", "hit", *(f"w{j}" for j in range(_WORDS)))
    table = table.toDF(block, *words)
    # Broadcast: at most `most` rows of nine numbers.
    found = rows.withColumn(block, _block(key, blocks)).join(F.broadcast(table), block, "left")
    inside = key.isNotNull()
    for word, bit in zip(words, _bits(key), strict=True):
        inside = inside & (F.col(word).bitwiseAND(bit) != 0)
    marked = found.withColumn(hit, F.coalesce(inside, F.lit(False))).select(*[F.col(f"`{c}`") for c in rows.columns], hit)
    return marked.filter(hit).drop(hit), marked.filter(~F.col(hit)).drop(hit)


def left_joined(rows: DataFrame, more: DataFrame, column: str) -> DataFrame:
    """A left join with a staged table: rows without a partner are not shuffled, as far as the filter tells them."""
    some, rest = probed(rows, F.col(column), more.select(column), column)
    own, added = [F.col(f"`{c}`") for c in rows.columns], [f for f in more.schema.fields if f.name != column]
    blanks = [F.lit(None).cast(f.dataType).alias(f.name) for f in added]
    found = some.join(more, column, "left").select(*own, *[f.name for f in added])
    return found.union(rest.select(*own, *blanks))


def inner_joined(rows: DataFrame, more: DataFrame, column: str) -> DataFrame:
    """An inner join with a staged table, that shuffles only rows that the filter lets through."""
    return probed(rows, F.col(column), more.select(column), column)[0].join(more, column)


def among(rows: DataFrame, keys: DataFrame, column: str) -> DataFrame:
    """The rows whose `column` is among that of a staged table of distinct keys."""
    some, _ = probed(rows, F.col(column), keys, column)
    return some.join(keys.select(column), column, "left_semi").select(*[F.col(f"`{c}`") for c in rows.columns])


def without(rows: DataFrame, keys: DataFrame, column: str) -> DataFrame:
    """The rows whose `column` is not among that of a staged table of keys; others are not shuffled, as far as the filter tells them."""
    some, rest = probed(rows, F.col(column), keys, column)
    return some.join(keys.select(column), column, "left_anti").select(*[F.col(f"`{c}`") for c in rows.columns]).union(rest)
