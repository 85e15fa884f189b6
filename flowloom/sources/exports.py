"""Export by time window: what would be written, and the write."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from flowloom.functions.clock import bound_text, ntz_literal, path_label, path_text
from flowloom.sources.csvfiles import read_csv, write_csv


_UNITS = {"second": 10**6, "minute": 60 * 10**6, "hour": 3600 * 10**6, "day": 86_400 * 10**6, "week": 7 * 86_400 * 10**6}


def window_label(start: Column, end: Column, prefix: str) -> Column:
    return F.concat(F.lit(prefix + "_"), path_label(bound_text(start)), F.lit("_to_"), path_label(bound_text(end)))


def _windows(ts: str, window: str) -> tuple[Column, Column]:
    """Bounds of the window a time lies in, NULL without a time. F.window would drop such rows."""
    step, epoch = F.lit(_micros(window)), ntz_literal(datetime(1970, 1, 1))
    since = F.timestamp_diff("MICROSECOND", epoch, ts)
    start = F.timestamp_add("MICROSECOND", since - F.pmod(since, step), epoch)
    return start, F.timestamp_add("MICROSECOND", step, start)


def _micros(window: str) -> int:
    """Length of a window in microseconds; weeks and shorter units have one."""
    count, unit = window.split()
    return int(count) * _UNITS[unit.rstrip("s").lower()]


def _label(start: Column, end: Column, prefix: str) -> Column:
    return F.when(start.isNull(), F.lit(f"{prefix}_no_time")).otherwise(window_label(start, end, prefix))


def export_manifest(df: DataFrame, ts: str = "ts", window: str = "1 day", prefix: str = "flows") -> DataFrame:
    """One row per window that holds rows: path label, bounds, number of rows; rows without a time have a label of their own."""
    start, end = _windows(ts, window)
    counts = df.groupBy(start.alias("window_start"), end.alias("window_end")).agg(F.count("*").alias("n"))
    label = _label(F.col("window_start"), F.col("window_end"), prefix)
    return counts.select(label.alias("path_label"), "window_start", "window_end", "n")


def export_windows(df: DataFrame, path: str, ts: str = "ts", window: str = "1 day", prefix: str = "flows") -> None:
    """Write each window of the table as CSV into a folder named by its label, rows without a time too.

    The rebalance hint gathers a window in few tasks but splits one that is too large for a task.
    """
    start, end = _windows(ts, window)
    labelled = df.withColumn("path_label", _label(start, end, prefix)).hint("rebalance", "path_label")
    write_csv(labelled, path, partition_by=["path_label"])


def read_windows(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """What `export_windows` wrote, with the label of each row."""
    return read_csv(spark, path, StructType([*schema.fields, StructField("path_label", StringType())]))


def export_flows(
    flows: DataFrame, folder: str, start: str, end: str, prefix: str = "flows", files: int | None = None
) -> str:
    """Write a flow table as CSV into one folder named by the bounds of its window; return the path.

    An existing path is an error. `files` sets the number of files and costs a shuffle.
    """
    path = f"{folder}/{prefix}_{path_text(start)}_to_{path_text(end)}.csv"
    write_csv(flows, path, files)
    return path
