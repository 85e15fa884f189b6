"""The most frequent keys, exactly, from small summaries and a second pass over the candidates."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowloom.sources.staging import stage
from flowloom.sources.workers import find_package

_SUMMARY = "lot int, keys array<bigint>, counts array<bigint>, less bigint"
#: Summaries that one task merges.
_FAN = 64
#: Counters of the first attempt for each key that is asked for, and of the last one.
_COUNTERS, MOST_COUNTERS = 64, 1 << 20


def merged(keys: np.ndarray, counts: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray, int]:
    """At most `most` counters, and what each key may have more: the counts of equal keys added up, less the first one left out.

    What is taken off a kept counter is taken off `most` others too, so a key that is not kept has at most 1 / (most + 1) of all rows.
    """
    distinct, place = np.unique(keys, return_inverse=True)
    sums = np.bincount(place, weights=None if not len(counts) else counts.astype(np.float64), minlength=len(distinct)).astype(np.int64)
    if len(distinct) <= most:
        return distinct, sums, 0
    less = int(np.partition(sums, len(sums) - most - 1)[len(sums) - most - 1])
    kept = sums > less
    return distinct[kept], sums[kept] - less, less


def _batch(lot: int, keys: np.ndarray, counts: np.ndarray, less: int) -> pa.RecordBatch:
    ends = pa.array([0, len(keys)], pa.int32())
    lists = [pa.ListArray.from_arrays(ends, pa.array(v, pa.int64())) for v in (keys, counts)]
    return pa.RecordBatch.from_arrays([pa.array([lot], pa.int32()), *lists, pa.array([less], pa.int64())], ["lot", "keys", "counts", "less"])


def summary(hashes: DataFrame, most: int) -> tuple[dict[int, int], int]:
    """Counters of one column of 64-bit keys, too low by at most the second value; a key without one is no more frequent than that.

    Every task sends one row of at most `most` counters; rows are merged up a tree of fan-in 64, and the last one comes to the driver.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        keys, counts, less = np.zeros(0, np.int64), np.zeros(0, np.int64), 0
        for batch in batches:
            own, times = np.unique(batch.column(0).to_numpy(zero_copy_only=False), return_counts=True)
            keys, counts, more = merged(np.concatenate([keys, own]), np.concatenate([counts, times]), most)
            less += more
        yield _batch(TaskContext.get().partitionId(), keys, counts, less)

    def merge(rows: pa.Table) -> pa.Table:
        flat = [np.concatenate([np.asarray(x.values) for x in rows.column(c)] or [np.zeros(0)]).astype(np.int64) for c in ("keys", "counts")]
        keys, counts, less = merged(*flat, most)
        total = less + sum(rows.column("less").to_pylist())
        return pa.Table.from_batches([_batch(rows.column("lot")[0].as_py(), keys, counts, total)])

    find_package(hashes.sparkSession)
    level = stage(hashes.mapInArrow(count, _SUMMARY), "summaries")
    lots = level.agg(F.max("lot")).first()[0] or 0
    while lots:
        lots //= _FAN
        level = stage(level.withColumn("lot", F.floor(F.col("lot") / _FAN).cast("int")).groupBy("lot").applyInArrow(merge, _SUMMARY), "summaries")
    row = level.first()
    return (dict(zip(row["keys"], row["counts"], strict=True)), row["less"]) if row else ({}, 0)


def top_keys(rows: DataFrame, keys: list[str], k: int, counters: int | None = None) -> DataFrame:
    """The k most frequent keys with their numbers of rows, ties by the keys, and their rank from 1.

    Summaries of 64-bit hashes name candidates; these alone are counted in a second pass, under their own values, so what
    comes out is exact. It is complete when the k-th is more frequent than any key outside the summary can be; otherwise the counters are
    doubled, up to a million, beyond which all keys are counted. Null keys count.
    """
    most = counters or max(1024, _COUNTERS * k)
    hashed = rows.select(F.xxhash64(*keys).alias("_hash"), *keys)
    while True:
        found, less = summary(hashed.select("_hash"), most)
        table = rows.sparkSession.createDataFrame([(h,) for h in found], "_hash bigint")
        # Broadcast: at most `most` rows of one number.
        counted = hashed.join(F.broadcast(table), "_hash").groupBy(*keys).agg(F.count("*").alias("n"))
        if not less:
            break
        least = counted.orderBy(F.desc("n")).limit(k).agg(F.count("*"), F.min("n")).first()
        # A key without a counter has at most `less` rows.
        if least[0] == k and least[1] > less:
            break
        most *= 2
        if most > MOST_COUNTERS:
            counted = rows.groupBy(*keys).agg(F.count("*").alias("n"))
            break
    best = counted.orderBy(F.desc("n"), *keys).limit(k)
    packed = best.agg(F.sort_array(F.collect_list(F.struct((-F.col("n")).alias("m"), *keys))).alias("all"))
    ranked = packed.select(F.posexplode("all").alias("rank", "r"))
    return ranked.select((F.col("rank") + 1).cast("long").alias("rank"), *[F.col(f"r.{c}").alias(c) for c in keys], (-F.col("r.m")).alias("n"))
