"""Documents that hold benchmark passages, found by the q-gram lemma and verified by banded alignment.

Texts are compared by their letters and digits: lower case, everything else one blank. A passage leaks if a window of an
item (64 characters, or the whole item if shorter) occurs in the text with at most 10 % edits. An item of fewer than 10
characters, which is allowed no edit, occurs where it stands between blanks or ends of the text, not inside words.

Filter. A window of m characters with at most k edits shares at least m - q + 1 - k q of its q-grams with the text, and these
lie on at most k + 1 neighbouring diagonals (place in the text less place in the item). Diagonals are cut into bands that
overlap by k, so one band holds them all. Hits are counted for each item and band; bands below the bound are dropped, and in
the others the windows below it, whatever place of the item they begin at. Short items have a smaller q, so that windows with
all their edits still share two q-grams.

Verification. Windows left are aligned with the text inside their band by dynamic programming, all of a batch at once. Of
neighbouring windows the part that they share goes first: where it exceeds the edits, each of them does. Where the text that
they cover together needs no more edits than that part, each of them needs just as many, and none is aligned by itself.

Distinct texts of the benchmark go to the tasks in blocks of bounded size, and ids of items with that text are joined to what was
found; documents are neither shuffled nor split. Places of q-grams that many items share are expanded for a part of the text at
a time.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowloom.llm.batches import map_all, slices, texts_of
from flowloom.llm.wordscan import rolled
from flowloom.operators.sizing import lookup_side
from flowloom.sources.staging import stage

#: Windows begin at every place of an item (a step of 1).
GRAM, WINDOW, STEP, EDITS = 8, 64, 1, 0.1
#: Items without a letter or digit are not searched.
SHORTEST = 1
_BAND = 32
#: Neighbouring windows whose shared part is aligned first.
_NEAR = 16
#: Benchmark text that tasks hold at a time; a longer item is a block of its own.
BLOCK_BYTES = 4 << 20
_SLICE = 2 << 20
_PIECE = 1 << 21
#: Places of q-grams in items that are expanded at a time.
_ENTRIES = 1 << 22
_APART = re.compile(r"[\W_]+")
_TABLE_BITS = 22


def normalized(text: str | None) -> str:
    return _APART.sub(" ", (text or "").lower()).strip()


def _points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def _grams(points: np.ndarray, size: int) -> np.ndarray:
    return rolled(points.astype(np.uint64) + np.uint64(1), size)


def _budget(length: int) -> tuple[int, int, int]:
    """Edits allowed in a window, the q for it, and q-grams it then shares at least, 2 or more (a window of one has one)."""
    edits = int(length * EDITS)
    gram = max(1, min(GRAM, (length - 1) // (edits + 1)))
    return edits, gram, length - gram + 1 - edits * gram


@dataclass
class Grams:
    """The q-grams of some items, for one q."""

    size: int
    keys: np.ndarray  # sorted distinct q-grams
    first: np.ndarray  # where the places of each begin
    owner: np.ndarray  # item of each place
    place: np.ndarray
    table: np.ndarray  # whether some q-gram ends in these bits

    @classmethod
    def of(cls, size: int, items: dict[int, np.ndarray]) -> Grams:
        grams = [_grams(points, size) for points in items.values()]
        every = np.concatenate(grams)
        owner = np.repeat(np.array([*items], np.int64), [len(g) for g in grams])
        place = np.concatenate([np.arange(len(g)) for g in grams])
        order = np.argsort(every, kind="stable")
        keys, first = np.unique(every[order], return_index=True)
        table = np.zeros(1 << min(_TABLE_BITS, len(keys).bit_length() + 7), bool)
        table[(keys & np.uint64(len(table) - 1)).astype(np.int64)] = True
        return cls(size, keys, np.append(first, len(every)), owner[order], place[order], table)

    def found(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of the points where a q-gram of the items begins, and which of the keys it is."""
        grams = _grams(points, self.size)
        at = np.flatnonzero(self.table[(grams & np.uint64(len(self.table) - 1)).astype(np.int64)])
        slot = np.searchsorted(self.keys, grams[at])
        slot[slot == len(self.keys)] = 0
        found = self.keys[slot] == grams[at]
        return at[found], slot[found]

    def entries(self, slot: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """How many places each of the keys has in the items, and all of them."""
        many = self.first[slot + 1] - self.first[slot]
        return many, np.repeat(self.first[slot] - np.cumsum(many) + many, many) + np.arange(many.sum())


@dataclass
class Index:
    """The q-grams of a block of items."""

    names: list
    items: list[np.ndarray]
    grams: list[Grams]
    words: list[Grams]  # whole items that are allowed no edit, between blanks
    needed: np.ndarray  # by item
    edits: np.ndarray

    @classmethod
    def of(cls, rows: list[tuple]) -> Index:
        texts = [(name, _points(text)) for name, text in ((n, normalized(t)) for n, t in rows) if len(text) >= SHORTEST]
        budgets = [_budget(min(WINDOW, len(points))) for _, points in texts]
        grams: dict[int, dict[int, np.ndarray]] = {}
        words: dict[int, dict[int, np.ndarray]] = {}
        for k, ((_, points), (edits, gram, _)) in enumerate(zip(texts, budgets, strict=True)):
            if edits:
                grams.setdefault(gram, {})[k] = points
            else:
                words.setdefault(len(points) + 2, {})[k] = np.pad(points, 1, constant_values=ord(" "))
        return cls(
            [n for n, _ in texts], [p for _, p in texts], [Grams.of(*some) for some in sorted(grams.items())],
            [Grams.of(*some) for some in sorted(words.items())], np.array([t for _, _, t in budgets], np.int64),
            np.array([k for k, _, _ in budgets], np.int64),
        )

    def exact(self, points: np.ndarray) -> Iterator[tuple[int, int, int, int]]:
        """(item, place in the points, 0, length) of the items that are allowed no edit."""
        points = np.pad(np.where(points == ord("\n"), ord(" "), points), 1, constant_values=ord(" "))
        for some in self.words if len(points) else []:
            at, slot = some.found(points)
            many, entry = some.entries(slot)
            at, item = np.repeat(at, many), some.owner[entry]
            for column in range(some.size - 2):
                same = points[at + 1 + column] == np.array([i[min(column, len(i) - 1)] for i in self.items], np.uint32)[item]
                at, item = at[same], item[same]
            yield from ((i, place, 0, some.size - 2) for place, i in zip(at.tolist(), item.tolist(), strict=True))

    def candidates(self, points: np.ndarray) -> list[tuple[int, int, int, int]]:
        """(item, first and last of neighbouring starts of windows of it, first diagonal of a band) with enough hits."""
        return [run for some in self.grams for run in self._runs(points, some)]

    def _runs(self, points: np.ndarray, some: Grams) -> list[tuple[int, int, int, int]]:
        at, slot = some.found(points)
        if len(points) > 8 * WINDOW and (some.first[slot + 1] - some.first[slot]).sum() > _ENTRIES:
            # Both halves hold more than a window with its edits of what is around the cut.
            half = len(points) // 2
            right = self._runs(points[half:], some)
            return self._runs(points[: half + 2 * WINDOW], some) + [(*run, first + half) for *run, first in right]
        many, entry = some.entries(slot)
        owner, place = some.owner[entry], some.place[entry]
        # Diagonals from 0 on: an item may begin before the text does.
        diagonal = np.repeat(at, many) - place + (1 << 31)
        again = diagonal % _BAND < self.edits[owner]
        pairs = (owner << 36) + diagonal // _BAND
        pairs, place = np.concatenate([pairs, pairs[again] - 1]), np.concatenate([place, place[again]])
        bands, hits = np.unique(pairs, return_counts=True)
        bands = bands[hits >= self.needed[bands >> 36]]
        if not len(bands):
            return []
        # The count again for each window by itself, where a q-gram of the item counts once however often the text has it.
        slot = np.minimum(np.searchsorted(bands, pairs), len(bands) - 1)
        inside = bands[slot] == pairs
        longest = max(len(item) for item in self.items)
        slot, place = np.divmod(np.unique(slot[inside] * longest + place[inside]), longest)
        sizes = np.array([len(item) for item in self.items], np.int64)[bands >> 36][slot]
        lengths = np.minimum(WINDOW, sizes)
        # A window has enough if it holds some place and the one that completes the count from there on.
        end = np.arange(len(place)) + self.needed[bands >> 36][slot] - 1
        among = end < len(place)
        end[~among] = 0
        low, high = np.maximum(0, place[end] - lengths + some.size), np.minimum(place, sizes - lengths)
        enough = among & (slot[end] == slot) & (low <= high)
        slot, low, high = slot[enough], low[enough], high[enough]
        if not len(slot):
            return []
        # Both ends grow within a band, so runs of starts that touch are one.
        begins = np.flatnonzero(np.append(True, (slot[1:] != slot[:-1]) | (low[1:] > high[:-1] + 1)))
        slot, low, high = slot[begins], low[begins], high[np.append(begins[1:], len(high)) - 1]
        item = bands[slot] >> 36
        first = (bands[slot] & ((1 << 36) - 1)) * _BAND - (1 << 31)
        return [*zip(item.tolist(), low.tolist(), high.tolist(), first.tolist(), strict=True)]

    def verify(self, points: np.ndarray, runs: list[tuple[int, int, int, int]]) -> list[tuple[int, int, int, int]]:
        """(item, place in the points, edits, window length) of the windows that occur within their budget."""
        shared = []
        for item, low, high, first in runs:
            length = min(WINDOW, len(self.items[item]))
            for start in range(low, high + 1, _NEAR):
                last = min(start + _NEAR - 1, high)
                shared.append((item, last, start + length - last, first, start))
        near = {(item, start, last, first): edits for (item, last, _, first, start), _, edits in self._aligned(points, shared)}
        whole = [(item, start, last - start + min(WINDOW, len(self.items[item])), first, last) for item, start, last, first in near]
        out = []
        for (item, start, length, first, last), place, edits in self._aligned(points, whole):
            if near[item, start, last, first] == edits:
                out.append((item, place, edits, length - last + start))
                del near[item, start, last, first]
        windows = [(i, s, min(WINDOW, len(self.items[i])), first) for i, start, last, first in near for s in range(start, last + 1)]
        return out + [(window[0], place, edits, window[2]) for window, place, edits in self._aligned(points, windows)]

    def _aligned(self, points: np.ndarray, parts: list[tuple]) -> Iterator[tuple[tuple, int, int]]:
        """(part, place in the points, edits) of the parts (item, start, length, first diagonal, …) within the item's budget."""
        todo: dict[tuple[int, int], list[tuple]] = {}
        for part in parts:
            todo.setdefault((part[2], int(self.edits[part[0]])), []).append(part)
        for (length, edits), some in todo.items():
            for k in range(0, len(some), 512):
                yield from self._align(points, length, edits, some[k : k + 512])

    def _align(self, points: np.ndarray, length: int, edits: int, parts: list[tuple]) -> list[tuple[tuple, int, int]]:
        # Column c stands for diagonal `low + c`; edits lead out of the band by `edits` at most.
        width = _BAND + 3 * edits + 1
        low = np.array([part[3] + part[1] - edits for part in parts])
        patterns = np.stack([self.items[part[0]][part[1] : part[1] + length] for part in parts])
        columns = np.arange(width)
        cost = np.zeros((len(parts), width), np.int32)
        for row in range(length):
            at = low[:, None] + columns + row
            inside = (at >= 0) & (at < len(points))
            text = np.where(inside, points[np.clip(at, 0, len(points) - 1)], 0)
            step = cost + (text != patterns[:, row, None])
            step[:, :-1] = np.minimum(step[:, :-1], cost[:, 1:] + 1)
            cost = np.minimum.accumulate(step - columns, axis=1) + columns
        best, column = cost.min(axis=1), cost.argmin(axis=1)
        return [(parts[w], max(0, int(low[w] + column[w])), int(best[w])) for w in np.flatnonzero(best <= edits)]


def _matches(index: Index, texts: list[str]) -> list[tuple[int, int, int, int]]:
    """(text, item, edits, window length): the best window of each item found in each text."""
    best: dict[tuple[int, int], tuple[int, int]] = {}
    reach = max((len(item) for item in index.items), default=0) + 4 * _BAND
    pieces, owners = [], []
    for k, text in enumerate(normalized(t) for t in texts):
        # A long text is taken in pieces that overlap by more than an item; where it is cut, no word ends.
        for begin in range(0, max(1, len(text) - reach), _PIECE):
            end = begin + _PIECE + reach
            pieces.append("\r" * (begin > 0) + text[begin:end] + "\r" * (end < len(text)))
            owners.append(k)
    # Line feeds are in no item. With so many between texts, a band of a window never reaches two of them, nor does a window.
    apart = _BAND + 3 * int(index.edits.max(initial=0)) + 1
    points = _points(("\n" * apart).join(pieces))
    ends = np.cumsum([len(p) + apart for p in pieces])
    for item, place, edits, length in [*index.exact(points), *index.verify(points, index.candidates(points))]:
        owner = owners[min(int(np.searchsorted(ends, place + length // 2, side="right")), len(owners) - 1)]
        now = best.get((owner, item))
        if now is None or edits * now[1] < now[0] * length:
            best[owner, item] = (edits, length)
    return [(owner, item, edits, length) for (owner, item), (edits, length) in sorted(best.items())]


def _items(benchmark: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """item_id, text, key: the normalised text of each item that is searched, and a digest of it."""
    rows = benchmark.select(F.col(f"`{id_col}`").alias("item_id"), F.col(f"`{text_col}`").cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = pa.array([normalized(text) for text in batch.column(1).to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays([batch.column(0), texts], ["item_id", "text"])

    rows = rows.filter("text is not null").mapInArrow(run, rows.schema)
    return rows.filter(F.char_length("text") >= SHORTEST).withColumn("key", F.sha2("text", 256))


def _blocks(items: DataFrame) -> Iterator[Index]:
    """The distinct texts of the items, named by their keys, in parts of some `BLOCK_BYTES`, one at a time on the driver."""
    texts = items.select("key", "text").distinct()
    total = texts.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    blocks = max(1, -(-total // BLOCK_BYTES))
    if blocks > 1:
        texts = stage(texts, "items")
    part = F.pmod(F.xxhash64("text"), F.lit(blocks))
    for k in range(blocks):
        block, held = [], 0
        for key, text in sorted(texts.filter(part == k).collect()):
            # Parts are even but for chance and long items.
            if block and held + len(text.encode()) > 2 * BLOCK_BYTES:
                yield Index.of(block)
                block, held = [], 0
            block.append((key, text))
            held += len(text.encode())
        if block or not k:
            yield Index.of(block)


def leaks(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """Per document and item found in it: doc_id, item_id, `edits` and `n_chars` of the window that fits best.

    Documents without a leak give no row. A null or empty text holds nothing; a null item or one without letters and digits is
    not searched. Rows that repeat are judged each; null ids stay null. Only the named columns are read.
    """
    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    ids = rows.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {ids}, key string, edits int, n_chars int"
    items = _items(benchmark, item_col, item_text_col)
    found = None
    for index in _blocks(items):
        shared = docs.sparkSession.sparkContext.broadcast(index)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for batch in slices(batches, "text", _SLICE):
                hits = _matches(shared.value, texts_of(batch.column("text")))
                if not hits:
                    continue
                columns = [
                    batch.column("doc_id").take(pa.array([h[0] for h in hits], pa.int64())),
                    pa.array([shared.value.names[h[1]] for h in hits], pa.string()),
                    pa.array([h[2] for h in hits], pa.int32()),
                    pa.array([h[3] for h in hits], pa.int32()),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "key", "edits", "n_chars"])

        part = rows.mapInArrow(run, schema)
        found = part if found is None else found.union(part)
    return found.join(lookup_side(items.select("key", "item_id")), "key").select("doc_id", "item_id", "edits", "n_chars")


def without_leaks(
    docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text"
) -> DataFrame:
    """The rows of `docs`, all columns, in which no item was found."""
    for index in _blocks(_items(benchmark, item_col, item_text_col)):
        shared = docs.sparkSession.sparkContext.broadcast(index)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for batch in slices(batches, text_col, _SLICE):
                keep = np.ones(batch.num_rows, bool)
                keep[[h[0] for h in _matches(shared.value, texts_of(batch.column(text_col)))]] = False
                yield batch.filter(pa.array(keep))

        docs = map_all(docs, run, docs.schema)
    return docs
