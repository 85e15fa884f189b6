"""CSV tables: declared schema in, the same rows out."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StringType, StructField, StructType

from flowloom.sources.foreign import read_foreign

# In texts a backslash, a line feed and a carriage return are written as a backslash and a letter. So NULL is the only
# `\N` in a file, a row is always one line, and files can be split.
_ESCAPES = (("\\", "\\b"), ("\n", "\\n"), ("\r", "\\r"))

# The defaults cut timestamps to milliseconds, trim blanks and read an empty text as NULL.
_LOSSLESS = {
    "header": True,
    "quoteAll": True,  # a line of blanks would be skipped on reading
    "escape": '"',
    "nullValue": "\\N",
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
}


def _changed(df: DataFrame, change: Callable[[Column], Column], binary: Callable[[Column], Column], schema: StructType) -> DataFrame:
    """The table with its text columns and its binary columns changed."""

    def one(field: StructField) -> Column:
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, StringType):
            return change(column).alias(field.name)
        return binary(column).alias(field.name) if isinstance(field.dataType, BinaryType) else column

    return df.select(*map(one, schema))


def _stored(schema: StructType) -> StructType:
    """The schema of the files: a binary value is written in base64."""
    return StructType([StructField(f.name, StringType() if isinstance(f.dataType, BinaryType) else f.dataType) for f in schema])


def _escaped(text: Column) -> Column:
    for mark, letter in _ESCAPES:
        text = F.replace(text, F.lit(mark), F.lit(letter))
    return text


def _unescaped(text: Column) -> Column:
    for mark, letter in reversed(_ESCAPES):
        text = F.replace(text, F.lit(letter), F.lit(mark))
    return text


def write_csv(
    df: DataFrame, path: str, files: int | None = None, partition_by: Sequence[str] = ()
) -> None:
    """Write a table as CSV files; an existing path is an error.

    Every value comes back as it was when `read_csv` reads it, line breaks, the text `\\N` and binary values included.

    Without `files` every task writes its own file and nothing is shuffled. `files` costs a
    shuffle and sets the number of writing tasks, so it should grow with the table.
    """
    # Spark breaks base64 into lines.
    escaped = _changed(df, _escaped, lambda value: F.translate(F.base64(value), "\r\n", ""), df.schema)
    out = escaped if files is None else escaped.repartition(files)
    out.write.options(**_LOSSLESS).partitionBy(*partition_by).csv(path)


def read_csv(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """Read CSV files written by `write_csv` with a declared schema; a row that does not fit is an error."""
    wanted = schema if isinstance(schema, StructType) else StructType.fromDDL(schema)
    rows = spark.read.options(**_LOSSLESS, mode="FAILFAST").schema(_stored(wanted)).csv(path)
    return _changed(rows, _unescaped, F.unbase64, wanted)


def read_text_columns(spark: SparkSession, path: str, *columns: str) -> DataFrame:
    """Named columns of foreign CSV files with a header, all as text and without a pass to infer types; see `foreign`."""
    return read_foreign(spark, path, *columns)


def read_text_columns_in_order(spark: SparkSession, path: str, *columns: str, name: str = "pos") -> DataFrame:
    """As `read_text_columns`, with the position of each row in the files (by file name, then by record)."""
    return read_foreign(spark, path, *columns, order=name)


def csv_roundtrip(df: DataFrame, path: str, files: int | None = None) -> DataFrame:
    """Write `df` to `path` as CSV and read it back with its own schema."""
    write_csv(df, path, files)
    return read_csv(df.sparkSession, path, df.schema)
