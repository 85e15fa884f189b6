"""Words covered by a window that occurs elsewhere, found through difference-cover anchors.

The residues D = {3, 6, 7, 12, 14} modulo 21 are a difference cover: for any two places i and j some d < 21 makes both
i + d and j + d fall on D. So two equal windows of 35 words hold, at the same distance d from their starts,
two equal runs of 15 words that both begin at a cover place. Only runs at cover places are hashed and compared over all
texts, 5 of 21. A run found twice is extended to the windows that may hold it: those that start up to 20 words before
it. These windows are hashed with 96 bits and counted; one found twice is a repeat.

Texts with an exact copy are repeats as a whole. Their words stand for others only once, by the smallest row.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowloom.llm.batches import bytes_of, map_all, slices
from flowloom.llm.bloom import fresh_names, inner_joined, left_joined, probed
from flowloom.llm.heavy import heavy_joined
from flowloom.llm.rowids import keyed, with_rid
from flowloom.llm.wordscan import doc_of, mixed, rolled, word_hashes
from flowloom.sources.staging import stage, staged_result

WINDOW = 35
# Perfect difference sets; every non-zero residue is the difference of exactly one pair.
_COVERS = {3: (0, 1), 7: (0, 1, 3), 13: (0, 1, 3, 9), 21: (3, 6, 7, 12, 14), 31: (1, 5, 11, 24, 25, 27)}
_SLICE = 2 << 20
_COPY, _FIRST_COPY = -1, -2
# A word and the white space behind it.
_WORD = re.compile(rb"[^\x20\x09-\x0D]+[\x20\x09-\x0D]*")


def _period(window: int) -> int:
    """The longest period that leaves runs of a third of the window at least."""
    return max((v for v in _COVERS if window - v + 1 >= max(2, window // 3)), default=0)


def _arrow(**columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns.values()], list(columns))


def _spread(keys: np.ndarray, rows: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(order, key, known): within a slice, a key that occurs again is known to be shared.

    Only its first row has to meet the rest of the table under its own key; the others get keys of their own, so a key
    that many rows share reaches a task once for each slice, not once for each row.
    """
    order = np.argsort(keys, kind="stable")
    ordered = keys[order]
    again = np.zeros(len(keys), bool)
    again[1:] = ordered[1:] == ordered[:-1]
    known = again.copy()
    known[:-1] |= again[1:]
    own = mixed(rows[order].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + places[order].astype(np.uint64))
    return order, np.where(again, own, ordered), known


def _anchors(docs: DataFrame, window: int) -> DataFrame:
    """Rows (key, known, rid, place): runs at cover places."""
    period = _period(window)
    run_length = window - period + 1 if period else window
    residues = np.zeros(max(period, 1), bool)
    residues[list(_COVERS[period]) if period else [0]] = True

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", _SLICE):
            hashes, counts = word_hashes(*bytes_of(batch.column("text")))
            runs = rolled(hashes, run_length)
            which, first = doc_of(counts), np.cumsum(counts) - counts
            place = np.arange(len(runs)) - first[which[: len(runs)]]
            # A run lies in one text, and some window of that text holds it.
            size = counts[which[: len(runs)]]
            chosen = np.flatnonzero(residues[place % len(residues)] & (place + run_length <= size) & (size >= window))
            rids = batch.column("rid").to_numpy(zero_copy_only=False)[which[chosen]]
            # 48 bits are enough to look for candidates.
            order, key, known = _spread(runs[chosen] >> np.uint64(16), rids, place[chosen])
            key = np.where(known, key, key & np.uint64((1 << 48) - 1)).view(np.int64)
            yield _arrow(key=key, known=known, rid=rids[order], place=place[chosen][order].astype(np.int32))

    return docs.select("rid", "text").mapInArrow(run, "key bigint, known boolean, rid bigint, place int")


def _windows(joined: DataFrame, window: int) -> DataFrame:
    """Rows (key, more, known, rid, place): windows that may hold a shared run."""
    period = max(_period(window), 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", _SLICE):
            hashes, counts = word_hashes(*bytes_of(batch.column("text")))
            first = np.cumsum(counts) - counts
            places = batch.column("places")
            sizes = np.diff(places.offsets.to_numpy())
            flat = places.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            which = np.repeat(np.arange(len(counts)), sizes)
            # The windows that start at place - d, d < period: a running sum over +1 and -1 marks them.
            marks = np.zeros(len(hashes) + 1, np.int32)
            np.add.at(marks, np.maximum(first[which] + flat - period + 1, first[which]), 1)
            np.add.at(marks, first[which] + flat + 1, -1)
            starts = np.flatnonzero(np.cumsum(marks[:-1]) > 0)
            owner = doc_of(counts)[starts]
            fits = starts - first[owner] + window <= counts[owner]
            starts, owner = starts[fits], owner[fits]
            keys = rolled(hashes, window)[starts]
            more = (rolled(hashes, window, 7)[starts] >> np.uint64(32)).astype(np.uint32).view(np.int32)
            rids = batch.column("rid").to_numpy(zero_copy_only=False)[owner]
            at = (starts - first[owner]).astype(np.int32)
            order, key, known = _spread(keys, rids, at)
            yield _arrow(key=key.view(np.int64), more=more[order], known=known, rid=rids[order], place=at[order])

    return joined.mapInArrow(run, "key bigint, more int, known boolean, rid bigint, place int")


def _shared(rows: DataFrame, *key: str) -> DataFrame:
    """(rid, place) of rows whose key occurs twice or more, or that are known to be shared.

    Keys are counted with a combine before the shuffle, and joined back to the rows that a filter of those found lets through.
    """
    rows = stage(rows, "keys")
    several = stage(rows.groupBy(*key).agg(F.count("*").alias("n")).filter("n > 1").select(*key), "several")
    maybe = stage(probed(rows.filter("not known"), F.col(key[0]), several, key[0])[0], "maybe")
    return heavy_joined(maybe, several, list(key)).select("rid", "place").union(rows.filter("known").select("rid", "place"))


def _copies(docs: DataFrame) -> DataFrame:
    """(rid, place) of texts, not empty, that occur twice or more; the place says whether the row is the first of its copies."""
    texts = stage(docs.filter("text <> ''").select("rid", F.md5("text").alias("text_key")), "texts")
    groups = texts.groupBy("text_key").agg(F.min("rid").alias("first"), F.count("*").alias("n")).filter("n > 1")
    mark = F.when(F.col("rid") == F.col("first"), _FIRST_COPY).otherwise(_COPY).alias("place")
    return heavy_joined(texts, stage(groups, "groups"), ["text_key"]).select("rid", mark)


def repeated_windows(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """From (rid, text): rid and `starts`, the places of its windows that occur elsewhere; -1 or -2: all of them. Staged."""
    return staged_result(docs.sparkSession, lambda: _repeated_windows(docs, window), "starts")


def _repeated_windows(docs: DataFrame, window: int) -> DataFrame:
    copies = stage(_copies(docs), "copies")
    runs = _shared(_anchors(docs, window), "key").union(copies)
    places = runs.groupBy("rid").agg(F.collect_list("place").alias("places"))
    # All but the first of equal texts are left out, their marks too.
    places = places.filter(~F.array_contains("places", _COPY))
    places = stage(places.select("rid", F.filter("places", lambda p: p >= 0).alias("places")), "places")
    joined = inner_joined(docs.select("rid", "text"), places, "rid").select("rid", "text", "places")
    starts = _shared(_windows(joined, window), "key", "more").union(copies)
    return starts.groupBy("rid").agg(F.collect_list("place").alias("starts"))


def _stay(n: int, begins: list[int] | None, window: int) -> list[bool] | None:
    """Which of n words stay, by the starts of repeated windows; None for all."""
    if not begins or n < window:
        return None
    if min(begins) < 0:
        return [False] * n
    marks = np.zeros(n + 1, np.int32)
    np.add.at(marks, np.array(begins), 1)
    np.add.at(marks, np.array(begins) + window, -1)
    return (np.cumsum(marks[:-1]) == 0).tolist()


def remove_repeats(docs: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, n_words, n_removed and `kept_text`, the words left, joined by single blanks.

    A word goes if some window of `window` words that covers it occurs elsewhere, in the same text or another, on the
    input. Words are runs of bytes other than blank, tab, line feed, vertical tab, form feed and carriage return. A null or empty text
    has no words and an empty rest; texts shorter than a window lose nothing. Rows that repeat are texts of their own, also under one
    id; null ids stay null. Only the two columns are read.

    Only texts that may hold a shared run are shuffled, as far as a Bloom filter of bounded size tells them from the rest.
    """
    rows, numbered = with_rid(docs, id_col, text_col)
    starts = repeated_windows(rows.select("rid", "text"), window)
    texts = left_joined(rows.select("rid", "text"), starts, "rid")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", _SLICE):
            totals, removed, kept = [], [], []
            data, offsets = bytes_of(batch.column("text"))
            content = data.tobytes()
            for k, begins in enumerate(batch.column("starts").to_pylist()):
                words = content[offsets[k] : offsets[k + 1]].split()
                stay = _stay(len(words), begins, window)
                left = words if stay is None else list(compress(words, stay))
                totals.append(len(words))
                removed.append(len(words) - len(left))
                kept.append(b" ".join(left))
            columns = [batch.column("rid"), pa.array(totals, pa.int64()), pa.array(removed, pa.int64())]
            columns.append(pa.array(kept, pa.binary()).cast(pa.string()))
            yield pa.RecordBatch.from_arrays(columns, ["rid", "n_words", "n_removed", "kept_text"])

    done = texts.mapInArrow(run, "rid bigint, n_words bigint, n_removed bigint, kept_text string")
    if numbered:
        return done.join(rows.select("rid", "doc_id"), "rid").select("doc_id", "n_words", "n_removed", "kept_text")
    return done.withColumnRenamed("rid", "doc_id")


def shortened(docs: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of `docs`, all columns, the words that `remove_repeats` removes cut out of the text.

    A word goes with the white space behind it; all else stays as it is, null texts too.
    """
    rows, rid = keyed(docs, id_col)
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    starts = repeated_windows(rows.select(F.col(f"`{rid}`").alias("rid"), text.alias("text")), window)
    extra = fresh_names(rows, "starts")[0]
    joined = left_joined(rows, starts.toDF(rid, extra), rid)
    schema = docs.schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(text_col).to_pylist()
            for k, begins in enumerate(batch.column(extra).to_pylist()):
                if begins:
                    content = texts[k].encode()
                    words = _WORD.findall(content)
                    stay = _stay(len(words), begins, window)
                    if stay is not None:
                        lead = content[: len(content) - len(content.lstrip())]
                        texts[k] = (lead + b"".join(compress(words, stay))).decode()
            columns = {f.name: batch.column(f.name) for f in schema}
            columns[text_col] = pa.array(texts, batch.column(text_col).type)
            yield pa.RecordBatch.from_pydict(columns)

    return map_all(joined, run, schema)


def digest(kept: DataFrame) -> DataFrame:
    """The contract's columns of what `remove_repeats` gives."""
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))
