"""Types of text columns, inferred in one pass that tasks combine."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: From narrow to wide; the first one that all values fit is a column's type. Every value is a string.
LATTICE = ("int", "bigint", "decimal", "double", "date", "timestamp", "string")
MOST_DIGITS = 38

_WHOLE = r"^[+-]?[0-9]+$"
_FIXED = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)$"
_FLOAT = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]{1,3})?$"
_DATE = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$"
_TIME = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}([ T][0-9]{2}:[0-9]{2}:[0-9]{2}(\.[0-9]{1,6})?)?$"


def _digits(value: Column, part: str) -> Column:
    """Digits before or behind the point of a number, leading noughts not counted."""
    return F.char_length(F.regexp_extract(value, r"^[+-]?0*([0-9]*)\.?([0-9]*)$", 1 if part == "whole" else 2))


def _fits(value: Column) -> dict[str, Column]:
    """Whether a value, not null, can be read as each type."""
    fixed = value.rlike(_FIXED)
    return {
        "int": value.rlike(_WHOLE) & value.try_cast("int").isNotNull(),
        "bigint": value.rlike(_WHOLE) & value.try_cast("bigint").isNotNull(),
        "decimal": fixed & (_digits(value, "whole") + _digits(value, "fraction") <= MOST_DIGITS),
        "double": value.rlike(_FLOAT),
        "date": value.rlike(_DATE) & value.try_cast("date").isNotNull(),
        "timestamp": value.rlike(_TIME) & value.try_cast("timestamp_ntz").isNotNull(),
    }


def inferred_types(df: DataFrame, *columns: str) -> DataFrame:
    """(column, type, n_values, n_nulls, one count of misfits for each type, whole_digits, fraction_digits).

    One pass over the text columns, in which each task sends one row; the rest is arithmetic on that row's sum. The counts say how many
    values stand in the way of each narrower type. A decimal has room for the longest whole and fraction parts and at most 38
    digits in all, else the column is double. A column without values, or of an empty table, is a string. Blanks are
    part of a value. Spark has no time zone here: timestamps are without one.
    """
    names = list(columns) or df.columns
    sums, entries = [], []
    for k, name in enumerate(names):
        value = F.col(f"`{name}`").cast("string")
        fixed = F.when(value.rlike(_FIXED), value)
        sums += [
            F.count(value).alias(f"_v{k}"),
            F.count(F.when(value.isNull(), 1)).alias(f"_z{k}"),
            F.coalesce(F.max(_digits(fixed, "whole")), F.lit(0)).alias(f"_w{k}"),
            F.coalesce(F.max(_digits(fixed, "fraction")), F.lit(0)).alias(f"_f{k}"),
            *[F.count(F.when(value.isNotNull() & ~fit, 1)).alias(f"_{kind}{k}") for kind, fit in _fits(value).items()],
        ]
        misfits = {kind: F.col(f"_{kind}{k}") for kind in LATTICE[:-1]}
        # The longest whole part and the longest fraction may come from different values.
        whole, fraction = F.col(f"_w{k}"), F.col(f"_f{k}")
        narrow = {kind: misfits[kind] == 0 for kind in misfits} | {"decimal": (misfits["decimal"] == 0) & (whole + fraction <= MOST_DIGITS)}
        said = F.concat(F.lit("decimal("), F.greatest(whole + fraction, F.lit(1)), F.lit(","), fraction, F.lit(")"))
        found = F.when(F.col(f"_v{k}") == 0, "string")
        for kind in misfits:
            found = found.when(narrow[kind], said if kind == "decimal" else F.lit("timestamp_ntz" if kind == "timestamp" else kind))
        entries.append(
            F.struct(
                F.lit(name).alias("column"), found.otherwise("string").alias("type"), F.col(f"_v{k}").alias("n_values"),
                F.col(f"_z{k}").alias("n_nulls"), *[n.alias(f"not_{kind}") for kind, n in misfits.items()],
                whole.cast("long").alias("whole_digits"), fraction.cast("long").alias("fraction_digits"),
            )
        )
    return df.agg(*sums).select(F.inline(F.array(*entries)))


def with_inferred_types(df: DataFrame, *columns: str) -> DataFrame:
    """The table with its text columns (or those named) read as the types that all their values fit; one row a column is collected."""
    types = {r["column"]: r["type"] for r in inferred_types(df, *columns).collect()}
    return df.select(*[F.col(f"`{c}`").cast(types[c]).alias(c) if c in types else F.col(f"`{c}`") for c in df.columns])
