"""Row numbers for tables whose ids may be null or repeat."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowloom.llm.bloom import fresh_names
from flowloom.operators.positions import numbered


def keyed(docs: DataFrame, id_col: str) -> tuple[DataFrame, str]:
    """The rows with all columns and one more, which is never null and never repeats; and its name."""
    name = fresh_names(docs, "rid")[0]
    key = F.col(f"`{id_col}`").cast("long")
    odd = docs.groupBy(key.alias("key")).agg(F.count("*").alias("n")).filter("n > 1 or key is null")
    if odd.isEmpty():
        return docs.withColumn(name, key), name
    return _placed(docs, key, [f"`{c}`" for c in docs.columns], name), name


def with_rid(docs: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, bool]:
    """(rid, doc_id, text), where rid is never null and never repeats, and whether rid is other than the id; a null text is empty.

    The id itself serves where it can: it compresses well and costs nothing. Otherwise the rows are numbered by id and text, and
    staged, since a number must not change when a task runs again.
    """
    rows = docs.select(
        F.col(f"`{id_col}`").cast("long").alias("doc_id"),
        F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"),
    )
    odd = rows.groupBy("doc_id").agg(F.count("*").alias("n")).filter("n > 1 or doc_id is null")
    if odd.isEmpty():
        return rows.filter("doc_id is not null").select(F.col("doc_id").alias("rid"), "doc_id", "text"), False
    return _placed(rows, F.col("doc_id"), ["text"], "rid").select("rid", "doc_id", "text"), True


def _placed(rows: DataFrame, key: Column, content: list[str], name: str) -> DataFrame:
    """The rows with their place by id (null last) and content, so it does not depend on how the table is split.

    Rows that are equal in all of that are equal; their place as read tells them apart.
    """
    order = fresh_names(rows, "row_key", "row_text", "row_more", "row_read")
    # A map has no hash of its own.
    parts = [F.to_json(F.struct(c)) if rows.schema[c.strip("`")].dataType.simpleString().find("map<") >= 0 else F.col(c) for c in content]
    values = [F.coalesce(key, F.lit((1 << 63) - 1)), F.xxhash64(F.lit("row"), *parts), F.xxhash64(F.lit("more"), *parts), F.monotonically_increasing_id()]
    marked = rows.withColumns(dict(zip(order, values, strict=True)))
    return numbered(marked, *order, name=name)[0].drop(*order)
