"""Bytes covered by a string of 400 bytes that occurs elsewhere, found with suffix arrays.

Shards. A suffix array over everything fits nowhere, so suffixes go to shards by content: a start's string of 400 bytes
holds 337 grams of 64 bytes; the one with the smallest hash, the leftmost of equals, is its anchor. Equal strings have
equal anchors, so all places where a string occurs meet under one anchor, and neighbouring starts mostly share theirs: a
start run with the bytes its strings cover is a region of some 570 bytes. Only anchors that occur twice or more go on.
Equal regions are one from there on, and if an anchor has only one region left, all its starts are repeats. Distinct regions of an
anchor are cut from the texts and form a shard with those of other anchors.

In a shard, the suffix array is refined by doubling (Larsson-Sadakane) to 400 bytes, common prefixes come from Kasai's
walk, and a start that shares 400 bytes with a neighbour is a repeat.

Anchors with very many distinct regions are cut over several shards. Each shard then publishes its distinct strings
as a sorted list of fingerprints, and lists are merged by binary search of each in the others, in slices of bounded size.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowloom.llm.batches import bytes_of, slices
from flowloom.llm.bloom import inner_joined, left_joined
from flowloom.llm.heavy import heavy_joined
from flowloom.llm.rowids import with_rid
from flowloom.llm.suffixes import Suffixes
from flowloom.llm.wordscan import mixed, rolled
from flowloom.sources.staging import stage, staged_result

LENGTH = 400
_GRAM_SHARE = 6
_SLICE = 2 << 20
#: Bytes of texts that are hashed at a time; arrays with eight bytes for each of them stay in a core's cache.
_HASHED = 256 << 10
_BLOCK = 4 << 20
_PLACE_BITS = np.uint64(24)
#: Regions of one anchor in a shard, and bytes at which a shard is closed. Lists of anchors with more regions are merged.
_REGIONS, _SHARD = 256, 2 << 20


def _codes(data: np.ndarray) -> np.ndarray:
    return mixed(np.arange(1, 257, dtype=np.uint64))[data]


def _anchors(data: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For every start of `length` bytes in `data`: the place of its anchor, the anchor's hash at each place, the string's hash."""
    gram = max(1, length // _GRAM_SHARE)
    codes = _codes(data)
    grams, strings = rolled(codes, gram), rolled(codes, length, 3)
    width = length - gram + 1
    # The place breaks ties, and reads off where the smallest is.
    keys = ((grams >> _PLACE_BITS) << _PLACE_BITS) | np.arange(len(grams), dtype=np.uint64)
    rows = -(-len(keys) // width)
    padded = np.full(rows * width, np.iinfo(np.uint64).max, np.uint64)
    padded[: len(keys)] = keys
    ahead = np.minimum.accumulate(padded.reshape(rows, width), axis=1).ravel()
    behind = np.minimum.accumulate(padded.reshape(rows, width)[:, ::-1], axis=1)[:, ::-1].ravel()
    starts = len(strings)
    least = np.minimum(behind[:starts], ahead[width - 1 : width - 1 + starts])
    return (least & ((np.uint64(1) << _PLACE_BITS) - np.uint64(1))).astype(np.int64), grams, strings


def _regions_of(data: np.ndarray, offsets: np.ndarray, length: int) -> dict[str, np.ndarray]:
    """Runs of starts with one anchor: anchor, region hash, row, first start, number of starts."""
    none = {k: np.zeros(0, np.int64) for k in ("anchor", "region", "row", "start", "n")}
    if len(data) < length:
        return none
    place, grams, strings = _anchors(data, length)
    sizes = np.diff(offsets)
    row = np.repeat(np.arange(len(sizes)), sizes)[: len(strings)]
    starts = np.flatnonzero(np.arange(len(strings)) + length <= offsets[1:][row])
    if not len(starts):
        return none
    row, place = row[starts], place[starts]
    opens = np.flatnonzero(np.concatenate([[True], (place[1:] != place[:-1]) | (row[1:] != row[:-1])]))
    counts = np.diff(opens, append=len(starts))
    # The distance from the anchor goes into the hash, so equal regions lie alike around it.
    content = mixed(strings[starts] + (place - starts).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    region = mixed(np.add.reduceat(content, opens) + counts.astype(np.uint64))
    return {
        "anchor": grams[place[opens]].view(np.int64),
        "region": region.view(np.int64),
        "row": row[opens],
        "start": starts[opens] - offsets[:-1][row[opens]],
        "n": counts,
    }


def _start_runs(docs: DataFrame, length: int) -> DataFrame:
    """(anchor, region, rid, start, n) over all texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", _HASHED):
            data, offsets = bytes_of(batch.column("text"))
            rids = batch.column("rid").to_numpy(zero_copy_only=False)
            # A text longer than a block is taken in blocks that overlap by what the last start needs.
            cuts = range(0, len(data), _BLOCK) if batch.num_rows == 1 else [0]
            for begin in cuts:
                if batch.num_rows == 1:
                    piece = data[begin : begin + _BLOCK + length - 1]
                    found = _regions_of(piece, np.array([0, len(piece)]), length)
                else:
                    found = _regions_of(data, offsets, length)
                columns = [found["anchor"], found["region"], rids[found["row"]]]
                columns += [(found["start"] + begin).astype(np.int64), found["n"].astype(np.int32)]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["anchor", "region", "rid", "start", "n"])

    return docs.select("rid", "text").mapInArrow(run, "anchor bigint, region bigint, rid bigint, start bigint, n int")


def _cut(wanted: DataFrame, length: int) -> DataFrame:
    """(anchor, region, parts, piece): the bytes of wanted regions, from (text, regions of that text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", _SLICE):
            data, offsets = bytes_of(batch.column("text"))
            content = data.tobytes()
            regions = batch.column("regions")
            sizes, flat = np.diff(regions.offsets.to_numpy()), regions.flatten()
            starts = flat.field("start").to_numpy() + np.repeat(offsets[:-1], sizes)
            ends = starts + flat.field("n").to_numpy() + length - 1
            pieces = pa.array([content[a:b] for a, b in zip(starts.tolist(), ends.tolist(), strict=True)], pa.binary())
            columns = [flat.field("anchor"), flat.field("region"), flat.field("parts"), pieces]
            yield pa.RecordBatch.from_arrays(columns, ["anchor", "region", "parts", "piece"])

    return wanted.mapInArrow(run, "anchor bigint, region bigint, parts int, piece binary")


_FOUND = "anchor bigint, region bigint, part int, first int, last int, slice int, strings binary"
#: A string that a shard publishes: two fingerprints, and a region and place where it stands.
_STRING = np.dtype([("print", "<u8"), ("more", "<u8"), ("region", "<i8"), ("at", "<i4")])
#: Slices of an anchor's lists for each of its parts.
_SLICES = 4


def _array(pieces: DataFrame, length: int) -> DataFrame:
    """Suffix arrays over shards. Rows with null `strings`: starts first to last - 1 of a region repeat; others: a slice of the sorted list
    of a shard's distinct strings."""

    names = [f.split()[0] for f in _FOUND.split(", ")]
    kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.binary()]

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*rows, strict=True)) or [()] * len(kinds)
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

    def shard(rows: list[tuple]) -> Iterator[pa.RecordBatch]:
        places = Suffixes([row[-1] for row in rows]).repeated(length)
        out: list[tuple] = []
        for (anchor, region, _, part, _), found in zip(rows, places, strict=True):
            for run in np.split(found, np.flatnonzero(np.diff(found) != 1) + 1) if len(found) else ():
                out.append((anchor, region, part, int(run[0]), int(run[-1]) + 1, None, None))
        yield batch_of(out)
        cut = [row for row in rows if row[2] > 1]
        if cut:
            yield batch_of(published(cut))

    def published(rows: list[tuple]) -> list[tuple]:
        """The distinct strings of each anchor, sorted, in slices by fingerprint."""
        codes = [_codes(np.frombuffer(row[-1], np.uint8)) for row in rows]
        prints, more = (np.concatenate([rolled(c, length, k) for c in codes]) for k in (5, 9))
        sizes = np.array([len(c) - length + 1 for c in codes])
        owner = np.repeat(np.arange(len(rows)), sizes)
        at = np.arange(len(owner)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        anchors, regions, parts, part = (np.array([row[k] for row in rows], np.int64)[owner] for k in range(4))
        order = np.lexsort((more, prints, anchors))
        same = [x[order][1:] == x[order][:-1] for x in (anchors, prints, more)]
        order = order[~np.concatenate([[False], same[0] & same[1] & same[2]])]
        slot = (prints % (parts * _SLICES).astype(np.uint64)).astype(np.int64)
        order = order[np.lexsort((slot[order], part[order], anchors[order]))]
        keys = [x[order] for x in (anchors, part, slot)]
        opens = np.flatnonzero(np.concatenate([[True], np.any([k[1:] != k[:-1] for k in keys], axis=0)]))
        strings = np.empty(len(order), _STRING)
        for name, values in zip(_STRING.names, (prints, more, regions, at), strict=True):
            strings[name] = values[order]
        pieces = np.split(strings, opens[1:])
        return [
            (int(a), None, int(p), None, None, int(s), piece.tobytes())
            for a, p, s, piece in zip(*(k[opens] for k in keys), pieces, strict=True)
        ]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        held, last = 0, None
        for batch in batches:
            names = ("anchor", "region", "parts", "part", "piece")
            for row in zip(*(batch.column(c).to_pylist() for c in names), strict=True):
                # An anchor's part is never cut; its size is bounded.
                if held >= _SHARD and (row[0], row[3]) != last:
                    yield from shard(rows)
                    rows, held = [], 0
                rows.append(row)
                held, last = held + len(row[-1]), (row[0], row[3])
        if rows:
            yield from shard(rows)

    dealt = pieces.withColumn("part", F.pmod(F.col("region"), F.col("parts")).cast("int"))
    dealt = dealt.repartition("anchor", "part").sortWithinPartitions("anchor", "part", "region")
    return dealt.select("anchor", "region", "parts", "part", "piece").mapInArrow(run, _FOUND)


def _merged(published: DataFrame) -> DataFrame:
    """(anchor, region, first, last) of strings that another shard of the same anchor publishes too."""

    def merge(rows: pa.Table) -> pa.Table:
        lists: dict[int, np.ndarray] = {}
        for part, data in zip(rows.column("part").to_pylist(), rows.column("strings").to_pylist(), strict=True):
            held = np.frombuffer(data, _STRING)
            lists[part] = np.concatenate([lists[part], held]) if part in lists else held
        lists = {p: held[np.lexsort((held["more"], held["print"]))] for p, held in lists.items()}
        found = []
        for p, mine in lists.items():
            hit = np.zeros(len(mine), bool)
            for q, held in lists.items():
                if q != p:
                    # Equal prints with other second halves are next to none; a run of them is looked through.
                    at = np.searchsorted(held["print"], mine["print"])
                    while (near := (at < len(held)) & (held["print"][np.minimum(at, len(held) - 1)] == mine["print"])).any():
                        there = np.minimum(at, len(held) - 1)
                        hit |= near & (held["more"][there] == mine["more"])
                        at = np.where(near, at + 1, len(held))
            found.append(mine[hit])
        both = np.concatenate(found)
        both = both[np.lexsort((both["at"], both["region"]))]
        region, at = both["region"], both["at"].astype(np.int64)
        # Neighbouring starts of one region are a run.
        opens = np.flatnonzero(np.concatenate([[True], (region[1:] != region[:-1]) | (at[1:] > at[:-1] + 1)])[: len(both)])
        last = np.append(opens[1:], len(both))[: len(opens)] - 1
        columns = [np.full(len(opens), rows.column("anchor")[0].as_py()), region[opens], at[opens], at[last] + 1]
        kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32())
        return pa.table([pa.array(c).cast(k) for c, k in zip(columns, kinds, strict=True)], names=["anchor", "region", "first", "last"])

    return published.groupBy("anchor", "slice").applyInArrow(merge, "anchor bigint, region bigint, first int, last int")


def repeated_starts(texts: DataFrame, length: int = LENGTH) -> DataFrame:
    """From (rid, text): rid and `runs`, an array of (first, last) of starts whose `length` bytes occur elsewhere. Staged."""
    return staged_result(texts.sparkSession, lambda: _repeated_starts(texts, length), "spans")


def _repeated_starts(texts: DataFrame, length: int) -> DataFrame:
    runs = stage(_start_runs(texts, length), "runs")
    regions = runs.groupBy("anchor", "region", "n").agg(F.count("*").alias("c"), F.min(F.struct("rid", "start")).alias("at"))
    regions = stage(regions, "regions")
    anchors = regions.groupBy("anchor").agg(F.sum("c").alias("places"), F.count("*").alias("kinds")).filter("places > 1")
    shared = stage(heavy_joined(regions, stage(anchors, "anchors"), ["anchor"]).select("anchor", "region", "n", "c", "at", "kinds"), "shared")
    several = shared.filter("kinds > 1")
    parts = F.ceil(F.col("kinds") / _REGIONS).cast("int").alias("parts")
    wanted = several.select(F.col("at.rid").alias("rid"), F.struct("at.start", "n", "anchor", "region", parts).alias("one"))
    wanted = stage(wanted.groupBy("rid").agg(F.collect_list("one").alias("regions")), "wanted")
    pieces = _cut(inner_joined(texts, wanted, "rid").select("text", "regions"), length)
    found = stage(_array(pieces, length), "repeats")
    within = found.filter("strings is null").select("anchor", "region", "first", "last")
    across = _merged(found.filter("strings is not null").select("anchor", "part", "slice", "strings"))
    equal = shared.filter("c > 1").select("anchor", "region", F.lit(0).alias("first"), F.col("n").alias("last"))
    repeats = equal.union(within).union(across)
    # A region has a bounded number of starts.
    packed = repeats.groupBy("anchor", "region").agg(F.collect_list(F.struct("first", "last")).alias("found"))
    keys = runs.select("anchor", "region", "rid", "start")
    placed = heavy_joined(keys, stage(packed, "packed"), ["anchor", "region"]).select("rid", "start", F.inline("found"))
    spans = placed.select("rid", F.struct((F.col("start") + F.col("first")).alias("first"), (F.col("start") + F.col("last")).alias("last")).alias("run"))
    return spans.groupBy("rid").agg(F.collect_list("run").alias("runs"))


def remove_repeats(docs: DataFrame, length: int = LENGTH, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, n_bytes, n_removed, `spans` (maximal removed byte ranges, from and to) and `kept`, the bytes left.

    A byte goes if a string of `length` bytes that covers it also starts at any other place, in the same text or another;
    overlaps count; strings are judged on the input. A null or empty text, or one shorter than `length`, loses nothing.
    Rows that repeat are texts of their own, also under one id; null ids stay null. Only the two columns are read. `kept` is
    binary, since a cut may fall inside a character.
    """
    rows, numbered = with_rid(docs, id_col, text_col)
    texts = rows.select("rid", "text")
    joined = left_joined(texts, repeated_starts(texts, length), "rid")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", _SLICE):
            data, offsets = bytes_of(batch.column("text"))
            content, sizes, spans, kept = data.tobytes(), np.diff(offsets), [], []
            for k, found in enumerate(batch.column("runs").to_pylist()):
                text, merged = content[offsets[k] : offsets[k + 1]], []
                for run in sorted((r["first"], r["last"] + length - 1) for r in found or ()):
                    if merged and run[0] <= merged[-1][1]:
                        merged[-1][1] = max(merged[-1][1], run[1])
                    else:
                        merged.append(list(run))
                ends = [0, *(x for span in merged for x in span), len(text)]
                kept.append(b"".join(text[a:b] for a, b in zip(ends[::2], ends[1::2], strict=True)))
                spans.append([{"from": a, "to": b} for a, b in merged])
            gone = [sum(s["to"] - s["from"] for s in own) for own in spans]
            kind = pa.list_(pa.struct([("from", pa.int64()), ("to", pa.int64())]))
            columns = [batch.column("rid"), pa.array(sizes), pa.array(gone, pa.int64()), pa.array(spans, kind), pa.array(kept, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["rid", "n_bytes", "n_removed", "spans", "kept"])

    schema = "rid bigint, n_bytes bigint, n_removed bigint, spans array<struct<from:bigint,to:bigint>>, kept binary"
    done = joined.mapInArrow(run, schema)
    if numbered:
        return done.join(rows.select("rid", "doc_id"), "rid").select("doc_id", "n_bytes", "n_removed", "spans", "kept")
    return done.withColumnRenamed("rid", "doc_id")


def digest(removed: DataFrame) -> DataFrame:
    """The contract's columns of what `remove_repeats` gives."""
    return removed.select(
        "doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256")
    )
