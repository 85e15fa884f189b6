"""Token counts of whole texts; huge texts are cut into overlapping chunks and spliced at proven borders.

A pre-token border p that two neighbouring chunks share is a proven splice point: matching and merging go on from a
border without looking back, so behind p both chunks have the tokens of the whole text, as long as the first one sees
far enough beyond p. It does for borders at least `_MARGIN` characters (a special string, or the longest contraction and
its next character) before its end. Chunk k is counted from the border it shares with k - 1 to the one it shares
with k + 1. Documents in which some pair of chunks shares none are cut again with chunks and overlaps eight times as
large, until a chunk is the whole text, which needs no border.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowloom.llm.batches import slices, texts_of
from flowloom.llm.encoded import library_ids
from flowloom.llm.vocab import library, specials
from flowloom.sources.staging import stage

CHUNK, OVERLAP = 1 << 15, 1 << 10
_WIDER = 8
_SLICE = 1 << 20
_CHUNK_SCHEMA = "n bigint, left array<struct<at:bigint,n:bigint>>, right array<struct<at:bigint,n:bigint>>"


def _margin(path: str) -> int:
    return 4 + max((len(s) for s in specials(path)), default=0)


def _count(rows: DataFrame, path: str) -> DataFrame:
    """`n_tokens` in place of `text`."""
    kept = [f for f in rows.schema.fields if f.name != "text"]
    schema = ", ".join([*(f"{f.name} {f.dataType.simpleString()}" for f in kept), "n_tokens bigint"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", _SLICE):
            counts = [len(library_ids(text, path, None)) // 4 for text in texts_of(batch.column("text"))]
            columns = [*(batch.column(f.name) for f in kept), pa.array(counts, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, [*(f.name for f in kept), "n_tokens"])

    return rows.mapInArrow(run, schema)


def _chunks(rows: DataFrame, size: int, overlap: int) -> DataFrame:
    """Rows (key, no, last, start, text): pieces of `size` characters, each beginning `overlap` before the last one's end."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", _SLICE):
            for key, text in zip(batch.column("key").to_pylist(), texts_of(batch.column("text")), strict=True):
                starts = range(0, max(1, len(text) - overlap), size - overlap)
                for k in range(0, len(starts), 16):
                    some = starts[k : k + 16]
                    columns = [[key] * len(some), range(k, k + len(some)), [s == starts[-1] for s in some], some]
                    pieces = [text[s : s + size] for s in some]
                    kinds = (pa.binary(), pa.int64(), pa.bool_(), pa.int64(), pa.string())
                    arrays = [pa.array(list(c), kind) for c, kind in zip([*columns, pieces], kinds, strict=True)]
                    yield pa.RecordBatch.from_arrays(arrays, ["key", "no", "last", "start", "text"])

    return rows.mapInArrow(run, "key binary, no bigint, last boolean, start bigint, text string")


def _borders(chunks: DataFrame, path: str, overlap: int) -> DataFrame:
    """Per chunk: its tokens, and for each border in its overlaps the place in the text and the tokens before it."""
    margin = _margin(path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", _SLICE):
            counts, lefts, rights = [], [], []
            texts = texts_of(batch.column("text"))
            starts = batch.column("start").to_pylist()
            for text, start in zip(texts, starts, strict=True):
                encoded = library(path).encode(text, add_special_tokens=False)
                words = np.array([-1 if w is None else w for w in encoded.word_ids], np.int64)
                offsets = np.array(encoded.offsets, np.int64).reshape(-1, 2)
                first = np.flatnonzero(np.diff(words, prepend=-2) != 0)
                places = offsets[first, 0] if len(first) else np.zeros(0, np.int64)
                left = places <= overlap - margin
                right = (places >= len(text) - overlap) & (places <= len(text) - margin)
                counts.append(len(words))
                lefts.append([{"at": int(p) + start, "n": int(n)} for p, n in zip(places[left], first[left], strict=True)])
                rights.append([{"at": int(p) + start, "n": int(n)} for p, n in zip(places[right], first[right], strict=True)])
            pairs = pa.list_(pa.struct([("at", pa.int64()), ("n", pa.int64())]))
            columns = [*(batch.column(c) for c in ("key", "no", "last")), pa.array(counts, pa.int64())]
            columns += [pa.array(lefts, pairs), pa.array(rights, pairs)]
            yield pa.RecordBatch.from_arrays(columns, ["key", "no", "last", "n", "left", "right"])

    return chunks.mapInArrow(run, f"key binary, no bigint, last boolean, {_CHUNK_SCHEMA}")


def _splice(borders: DataFrame) -> DataFrame:
    """Per key: the tokens of the text, null when some pair of chunks shares no border."""
    order = Window.partitionBy("key").orderBy("no")
    shared = F.array_intersect(F.col("right.at"), F.lead("left.at").over(order))
    # The middle one: far from the ends of both.
    joint = F.when(~F.col("last"), F.get(shared, F.floor(F.size(shared) / 2).cast("int")))

    def before(pairs: str, place: Column) -> Column:
        return F.get(F.filter(pairs, lambda pair: pair["at"] == place), 0)["n"]

    ends = borders.withColumn("joint", joint).withColumn("from", F.lag("joint").over(order))
    upto = F.when(F.col("last"), F.col("n")).otherwise(before("right", F.col("joint")))
    since = F.when(F.col("no") == 0, F.lit(0)).otherwise(before("left", F.col("from")))
    part = ends.select("key", (upto - since).alias("part"))
    return part.groupBy("key").agg(F.when(F.count("part") == F.count("*"), F.sum("part")).alias("n_tokens"))


def token_counts(
    docs: DataFrame, path: str, limit: int = 1024, id_col: str = "doc_id", text_col: str = "text",
    chunk: int = CHUNK, overlap: int = OVERLAP,
) -> DataFrame:
    """Per row: doc_id, n_bytes, n_tokens, over_limit.

    A null text counts as empty: 0 bytes, 0 tokens. Rows that repeat give a row each; null ids stay null. Only two columns
    are read. Texts of up to `chunk` characters are counted where they lie, without a shuffle; the chunks
    of longer ones spread over all tasks.
    """
    if overlap <= 2 * _margin(path) or chunk < 3 * overlap:
        raise ValueError("a chunk must be three overlaps long, an overlap longer than two margins")
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"), text.alias("text"))
    rows = rows.withColumn("n_bytes", F.octet_length("text").cast("long"))
    short = _count(rows.filter(F.length("text") <= chunk), path)
    # Equal texts are the same work: they are counted once.
    long = rows.filter(F.length("text") > chunk).withColumn("key", F.unhex(F.sha2("text", 256)))
    todo, done = long, []
    while True:
        pieces = _chunks(todo.select("key", "text"), chunk, overlap).dropDuplicates(["key", "no"])
        counted = stage(_splice(_borders(pieces, path, overlap)), "counts")
        done.append(counted.filter(F.col("n_tokens").isNotNull()))
        failed = counted.filter(F.col("n_tokens").isNull()).select("key")
        if failed.isEmpty():
            break
        todo = todo.join(failed, "key", "left_semi")
        chunk, overlap = chunk * _WIDER, overlap * _WIDER
    counts = done[0]
    for more in done[1:]:
        counts = counts.union(more)
    whole = long.select("doc_id", "n_bytes", "key").join(counts, "key").select("doc_id", "n_bytes", "n_tokens")
    return short.unionByName(whole).withColumn("over_limit", F.col("n_tokens") > limit)
