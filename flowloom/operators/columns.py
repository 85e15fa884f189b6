"""Typed columns from text."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def typed_projection(raw: DataFrame, schema: StructType | str) -> DataFrame:
    """Text columns as the types and in the order of `schema`; a text that does not fit becomes NULL."""
    if isinstance(schema, str):
        schema = StructType.fromDDL(schema)
    return raw.select(*[F.col(f"`{f.name}`").try_cast(f.dataType).alias(f.name) for f in schema])
