"""BPE encoding and decoding as a bounded-lookahead streaming transducer.

Merges run in rank order. Take two texts with a common beginning. While merges run, the beginning's last token common
to both can be lost only when a merge (u, v) takes it as u, with a v that starts at the frontier in one of the two
texts. The next loss needs a later merge whose v starts with that u. So the frontier moves left by at most the heaviest
chain of merges of rising rank in which the left part of each is a beginning of the right part of the next. Its weight is the
merge list's sufficient lookahead: what lies further than this from the end of what was read cannot change any more.

The encoder reads symbols into a buffer, merges it when it holds more than twice the lookahead, emits the tokens that
end before the lookahead, and goes on from that token border. Its buffer is bounded whatever the length of a word.

Texts are read in blocks. A text may be cut before white space that follows another character; what lies behind the last such place
waits for the next block. Where a block has none, pre-tokens leave as soon as two more have begun, and one that fills a block goes
through the encoder while it is read. So the state beside the result is a block, the merge buffer and two characters. The
decoder is a state machine too: it takes ids in blocks and keeps at most the unfinished bytes of one character.

Most pre-tokens are short and come again. A slice's pre-tokens that a worker does not remember are merged side by side as arrays.
"""

from __future__ import annotations

import codecs
import functools
import heapq
import struct
import unicodedata
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowloom.llm.batches import lists, slices, texts_of
from flowloom.llm.pretokens import SPACE, pretokens
from flowloom.llm.sidemerge import PairTable
from flowloom.llm.vocab import byte_letters, parts, settings, specials

_SLICE = 2 << 20
# Words whose ids a worker remembers; the memory is emptied when full, so its size is bounded and results don't depend on it.
_REMEMBERED = 1 << 19
_SHORT = 48
#: Code points and ids that are read at a time.
BLOCK = 1 << 12


class Merges:
    """A merge list: symbols, ranks, and its sufficient lookahead."""

    def __init__(self, path: str):
        model = settings(path)["model"]
        self.ids: dict[str, int] = model["vocab"]
        self.suffix: str = model.get("end_of_word_suffix") or ""
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        #: (left id, right id) -> (rank, id of both)
        self.ranks = {
            (self.ids[a], self.ids[b]): (rank, self.ids[a + b]) for rank, (a, b) in reversed(list(enumerate(pairs)))
        }
        self.byte_ids = [self.ids[byte_letters()[b]] for b in range(256)]
        self.last_ids = [self.ids.get(byte_letters()[b] + self.suffix, self.byte_ids[b]) for b in range(256)]
        self.lookahead = self._lookahead()
        self.table = PairTable(self.ranks)
        self.first_symbols, self.last_symbols = np.array(self.byte_ids, np.int64), np.array(self.last_ids, np.int64)

    def _lookahead(self) -> int:
        size = {i: 1 for i in (*self.byte_ids, *self.last_ids)}
        left_parts: dict[int, list[int]] = {}
        heaviest: dict[int, int] = {}  # by the left part of a chain's last merge

        def below(token: int) -> int:
            return max(heaviest.get(token, 0), max((below(part) for part in left_parts.get(token, ())), default=0))

        most = 1
        for (left, right), (_, both) in sorted(self.ranks.items(), key=lambda item: item[1][0]):
            weight = size[left] + below(right)
            heaviest[left] = max(heaviest.get(left, 0), weight)
            size[both] = size[left] + size[right]
            left_parts.setdefault(both, []).append(left)
            most = max(most, weight)
        # One token more: the frontier is a token border, and the token that spans the wanted place ends behind it.
        return most + max(size.values())

    def merged(self, symbols: list[int]) -> list[int]:
        """The tokens of one sequence."""
        return self._queued(symbols)

    def merged_words(self, words: list[bytes]) -> list[bytes]:
        """The ids of short pre-tokens, none empty, as bytes of 32-bit integers."""
        data, sizes = np.frombuffer(b"".join(words), np.uint8), np.array(list(map(len, words)), np.int64)
        symbols = self.first_symbols[data]
        ends = np.cumsum(sizes) - 1
        symbols[ends] = self.last_symbols[data[ends]]
        tokens, counts = self.table.merged(symbols, sizes)
        ids, ends = tokens.astype("<i4").tobytes(), (4 * np.cumsum(counts)).tolist()
        return [ids[a:b] for a, b in zip([0, *ends], ends, strict=False)]

    def _queued(self, symbols: list[int]) -> list[int]:
        """The lowest rank first, from the left, with a queue of pairs."""
        ranks, n = self.ranks, len(symbols)
        tokens: list[int | None] = list(symbols)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        queue = [(ranks[p][0], i, p) for i, p in enumerate(zip(symbols, symbols[1:], strict=False)) if p in ranks]
        heapq.heapify(queue)
        while queue:
            _, i, pair = heapq.heappop(queue)
            j = after[i]
            if tokens[i] != pair[0] or j >= n or tokens[j] != pair[1]:
                continue
            tokens[i], tokens[j] = ranks[pair][1], None
            after[i] = after[j]
            if after[j] < n:
                before[after[j]] = i
            for at in (before[i], i):
                if at >= 0 and after[at] < n:
                    fresh = (tokens[at], tokens[after[at]])
                    if fresh in ranks:
                        heapq.heappush(queue, (ranks[fresh][0], at, fresh))
        return [t for t in tokens if t is not None]


class Encoder:
    """Bytes of one pre-token in, stable tokens out."""

    def __init__(self, merges: Merges):
        self.merges = merges
        self.buffer: list[int] = []
        self.sizes: dict[int, int] = {}

    def _size(self, token: int) -> int:
        if not self.sizes:
            letters = {i: t for t, i in self.merges.ids.items()}
            self.sizes = {i: len(t.removesuffix(self.merges.suffix) if self.merges.suffix else t) for i, t in letters.items()}
        return self.sizes[token]

    def feed(self, data: bytes) -> list[int]:
        """Take bytes that are not the pre-token's last one; return the tokens that have become stable."""
        out, block = [], 2 * self.merges.lookahead
        for at in range(0, len(data), block):
            self.buffer.extend(self.merges.byte_ids[b] for b in data[at : at + block])
            if len(self.buffer) >= 2 * block:
                out += self._emit()
        return out

    def _emit(self) -> list[int]:
        stable, out, end = len(self.buffer) - self.merges.lookahead, [], 0
        for token in self.merges.merged(self.buffer):
            if end + self._size(token) > stable:
                break
            out.append(token)
            end += self._size(token)
        self.buffer = self.buffer[end:]
        return out

    def finish(self, last: int) -> list[int]:
        """Take the last byte; return the remaining tokens."""
        out = self.merges.merged([*self.buffer, self.merges.last_ids[last]])
        self.buffer = []
        return out


class Decoder:
    """Ids in, text out as soon as it is known. Without a byte decoder in the file, tokens are joined by blanks."""

    def __init__(self, path: str):
        self.names = names(path)
        self.by_bytes = (settings(path)["decoder"] or {}).get("type") == "ByteLevel"
        self.special = set(specials(path).values())
        self.state = codecs.getincrementaldecoder("utf-8")("replace")
        self.begun = False

    def feed(self, ids: Iterable[int]) -> str:
        try:
            known = list(map(self.names.__getitem__, ids))
        except KeyError:
            ids = [i for i in ids if i in self.names]
            known = list(map(self.names.__getitem__, ids))
        if self.by_bytes:
            back = _letter_bytes()
            return "".join(
                self.state.decode(name.encode() if i in self.special else bytes(back[c] for c in name))
                for i, name in zip(ids, known, strict=True)
            )
        text = " ".join(known)
        if known and self.begun:
            text = " " + text
        self.begun = self.begun or bool(known)
        return text

    def finish(self) -> str:
        return self.state.decode(b"", True) if self.by_bytes else ""


@functools.cache
def _letter_bytes() -> dict[str, int]:
    return {letter: b for b, letter in byte_letters().items()}


@functools.cache
def names(path: str) -> dict[int, str]:
    """Id -> token, special ones included."""
    vocab = settings(path)["model"]["vocab"]
    return {i: t for t, i in vocab.items()} | {i: t for t, i in specials(path).items()}


@functools.cache
def merges(path: str) -> Merges:
    return Merges(path)


class _Words(dict):
    """Ids of short pre-tokens that a worker remembers, as bytes of 32-bit integers."""

    def __init__(self, path: str):
        super().__init__()
        self.merges, self.older = merges(path), {}

    def learn(self, items: set[str | bytes]) -> None:
        """Have the ids of all short words among these; those not asked for since the memory was last full are forgotten."""
        fresh = {w for w in items.difference(self) if w.__class__ is str and len(w) <= _SHORT}
        if len(self) + len(fresh) > _REMEMBERED:
            self.older = dict(self)
            self.clear()
        for word in fresh.intersection(self.older):
            self[word] = self.older[word]
        missing = list(fresh.difference(self.older))
        if missing:
            self.update(zip(missing, self.merges.merged_words([word.encode() for word in missing]), strict=True))


@functools.cache
def _words(path: str) -> _Words:
    return _Words(path)


#: Code points that may join with the one before them: no text is cut in front of them.
@functools.cache
def _joining() -> frozenset[str]:
    pairs = (unicodedata.decomposition(chr(c)).split() for c in range(0x110000))
    seconds = {chr(int(p[1], 16)) for p in pairs if len(p) == 2 and not p[0].startswith("<")}
    return frozenset(seconds | set(map(chr, range(0x1160, 0x1200))))


def _may_begin(char: str) -> bool:
    """Whether the normal form of what comes before does not depend on this character."""
    return char.isascii() or unicodedata.combining(char) == 0 and char not in _joining()


class TextEncoder:
    """Blocks of a text in; into `out` go pre-tokens (str) and ids (bytes of 32-bit integers), as soon as they are sure."""

    def __init__(self, path: str, block: int):
        self.path, self.block = path, max(block, 16)
        self.raw, self.carry = "", ""
        self.long: Encoder | None = None
        self.out: list[str | bytes] = []

    def feed(self, text: str) -> None:
        self.raw += text
        if len(self.raw) < self.block:
            return
        cut = self._border()
        if cut:
            head, self.raw = self.raw[:cut], self.raw[cut:]
            self._take(head, True)
        elif len(self.raw) >= 2 * self.block:
            cut = self._inner_border()
            head, self.raw = self.raw[:cut], self.raw[cut:]
            self._take(head, False)

    def finish(self) -> None:
        head, self.raw = self.raw, ""
        self._take(head, True)

    def _border(self) -> int:
        """The last place before white space that follows another character, 0 if there is none."""
        raw, at = self.raw, len(self.raw)
        while True:
            found = _BORDER.search(raw, 0, at) if at <= 64 else _BORDER.search(raw, at - 64, at)
            if found:
                last = found
                for last in _BORDER.finditer(raw, found.start(), at):
                    pass
                return last.start() + 1
            if at <= 64:
                return 0
            at -= 62

    def _inner_border(self) -> int:
        """A place where the normal form and the special strings do not reach over; 0 if there is none."""
        raw, cut = self.raw, len(self.raw) - 1
        while cut and not (_may_begin(raw[cut]) and _may_begin(raw[cut - 1])):
            cut -= 1
        begun = [k for s in specials(self.path) for k in range(1, len(s)) if raw.endswith(s[:k], 0, cut)]
        return cut - max(begun, default=0)

    def _take(self, head: str, whole: bool) -> None:
        """The text up to a border; where it is no whole section, the last two pre-tokens wait."""
        pieces = parts(head, self.path)
        for k, (part, special) in enumerate(pieces):
            if special is not None:
                self._words("", True)
                self.out.append(struct.pack("<i", special))
            else:
                self._words(part, whole or k + 1 < len(pieces))
        if whole:
            self._words("", True)

    def _words(self, part: str, whole: bool) -> None:
        text, self.carry = self.carry + part, ""
        if not text:
            return
        words = list(pretokens(text, self.path))
        sure = len(words) if whole else max(0, len(words) - 2)
        if self.long and (sure or whole):
            # The first one ends what the encoder has begun.
            first = words[0].encode()
            self.out.append(np.array(self.long.feed(first[:-1]) + self.long.finish(first[-1]), "<i4").tobytes())
            self.long, words, sure = None, words[1:], sure - 1
        if whole:
            self.out += words
            return
        self.out += words[:sure]
        rest = words[sure:]
        if rest and len(rest[0]) > self.block // 2:
            # Two characters wait, so that what comes next is cut as it would be behind the whole.
            self.long = self.long or Encoder(merges(self.path))
            self.out.append(np.array(self.long.feed(rest[0][:-2].encode()), "<i4").tobytes())
            rest[0] = rest[0][-2:]
        self.carry = "".join(rest)


_BORDER = regex.compile(f"[^{SPACE}][{SPACE}]")


def _items(text: str, path: str, block: int) -> list[str | bytes]:
    encoder = TextEncoder(path, block)
    for at in range(0, len(text), block):
        encoder.feed(text[at : at + block])
    encoder.finish()
    return encoder.out


def slice_ids(texts: list[str], path: str, block: int = BLOCK) -> list[bytes]:
    """The ids of whole texts as little-endian 32-bit integers; their words are merged side by side."""
    known = _words(path)
    items = [_items(text, path, block) for text in texts]
    found = [list(map(known.get, own)) for own in items]
    missing: list[tuple[int, int]] = []
    for k, ids in enumerate(found):
        if None in ids:
            missing += [(k, at) for at, known_ids in enumerate(ids) if known_ids is None]
    known.learn({items[k][at] for k, at in missing})
    for k, at in missing:
        item = items[k][at]
        found[k][at] = item if item.__class__ is bytes else known.get(item) or np.array(word_ids(item, path), "<i4").tobytes()
    return list(map(b"".join, found))


def word_ids(word: str, path: str) -> list[int]:
    """The ids of one pre-token."""
    encoder, data = Encoder(merges(path)), word.encode()
    return encoder.feed(data[:-1]) + encoder.finish(data[-1])


def text_ids(text: str, path: str) -> bytes:
    """The ids of a whole text as little-endian 32-bit integers."""
    return slice_ids([text], path)[0]


def decoded(ids: list[int], path: str) -> str:
    """The text of one id sequence, as `decode(ids, skip_special_tokens=False)`."""
    decoder = Decoder(path)
    pieces = [decoder.feed(ids[at : at + BLOCK]) for at in range(0, len(ids), BLOCK)]
    return "".join(pieces) + decoder.finish()


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", decode: bool = True) -> DataFrame:
    """Per row: id, `ids` (array of the ids of the whole text) and, unless `decode` is false, `decoded`.

    A null text counts as empty: no ids, empty decoded text. Rows that repeat give a row each; a null id stays null. Other
    columns are not read, so their names cannot clash. No shuffle; one task holds one slice of texts at a time.
    """
    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    schema = f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, ids array<int>" + ", decoded string" * decode

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", _SLICE):
            encoded = slice_ids(texts_of(batch.column("text")), path)
            ids = np.frombuffer(b"".join(encoded), "<i4")
            counts = np.array([len(e) // 4 for e in encoded], np.int64)
            columns = [batch.column("doc_id"), lists(ids, counts, pa.int32())]
            if decode:
                columns.append(pa.array([decoded(np.frombuffer(e, "<i4").tolist(), path) for e in encoded], pa.string()))
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "ids", "decoded"][: len(columns)])

    return rows.mapInArrow(run, schema)


def digest(encoded: DataFrame) -> DataFrame:
    """Digests of what `encode` gives."""
    ids = F.array_join(F.col("ids").cast("array<string>"), " ")
    return encoded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(ids, 256).alias("ids_sha256"),
        F.sha2(F.col("decoded"), 256).alias("decoded_sha256"),
    )
