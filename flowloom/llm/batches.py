"""Helpers for code that runs inside Spark tasks on Arrow batches."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import StructType


def slices(batches: Iterator[pa.RecordBatch], column: str, limit: int) -> Iterator[pa.RecordBatch]:
    """Cut batches into runs of rows whose `column` holds about `limit` bytes; a longer row stands alone."""
    for batch in batches:
        if not batch.num_rows:
            continue
        offsets = bytes_of(batch.column(column))[1]
        first = 0
        while first < batch.num_rows:
            last = int(np.searchsorted(offsets, offsets[first] + limit, side="right")) - 1
            last = min(max(last, first + 1), batch.num_rows)
            yield batch.slice(first, last - first)
            first = last


def map_all(df: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: StructType) -> DataFrame:
    """`mapInArrow` over all columns, whatever their names; Spark's own fails for names with dots."""
    names = df.columns

    def named(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return run(pa.RecordBatch.from_arrays(batch.columns, names) for batch in batches)

    return df.toDF(*[f"c{k}" for k in range(len(names))]).mapInArrow(named, schema)


def bytes_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a text column and the offsets of its rows (one more than rows); null counts as empty."""
    if column.null_count:
        column = column.fill_null(b"" if pa.types.is_binary(column.type) else "")
    wide = column.cast(pa.large_binary())
    _, offsets, data = wide.buffers()
    if not len(wide):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(offsets, np.int64)[wide.offset : wide.offset + len(wide) + 1]
    content = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return content[offsets[0] : offsets[-1]], offsets - offsets[0]


def texts_of(column: pa.Array) -> list[str]:
    """The texts of a column, null as empty."""
    return ["" if text is None else text for text in column.to_pylist()]


def lists(values: np.ndarray, counts: np.ndarray, kind: pa.DataType) -> pa.Array:
    """An array column from its flat values and the number of values of each row."""
    offsets = np.zeros(len(counts) + 1, np.int32)
    np.cumsum(counts, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, kind))


_KINDS = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary(), "string": pa.string(), "boolean": pa.bool_()}


def arrow_schema(ddl: str) -> pa.Schema:
    """The Arrow schema of `name type, name type, ...`, for a few simple types."""
    return pa.schema([(name, _KINDS[kind]) for name, kind in (field.split() for field in ddl.split(", "))])


def rows_batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    """A batch of rows, possibly none."""
    columns = list(zip(*rows, strict=True)) or [()] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)
