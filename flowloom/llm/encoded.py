"""Ids of whole texts as the tokenizers library gives them."""

from __future__ import annotations

import functools
import struct

from flowloom.llm.pretokens import pretokens
from flowloom.llm.vocab import byte_letters, library, parts

# Pre-tokens that a worker remembers, and the longest of them: a bound on memory, not on results.
_REMEMBERED, _SHORT = 3 << 17, 48


class _Known(dict):
    """Ids of pre-tokens as bytes of 32-bit integers; asks the library for what is missing."""

    def __init__(self, path: str):
        super().__init__()
        self.older: dict[str, bytes] = {}
        self.model = library(path).model
        self.letters = str.maketrans({chr(b): letter for b, letter in byte_letters().items()})

    def __missing__(self, word: str) -> bytes:
        ids = self.older.get(word)
        if ids is None:
            found = self.model.tokenize(word.encode().decode("latin-1").translate(self.letters))
            ids = struct.pack(f"<{len(found)}I", *[token.id for token in found])
        if len(word) <= _SHORT:
            if len(self) >= _REMEMBERED:
                # What was not asked for since the memory was last full is forgotten.
                self.older = dict(self)
                self.clear()
            self[word] = ids
        return ids


@functools.cache
def _known(path: str) -> _Known:
    return _Known(path)


def library_ids(text: str, path: str, end: int | None) -> bytes:
    """The ids of a whole text as the library gives them, as bytes of 32-bit integers, with `end` behind them.

    Merges never cross pre-tokens, so the library's model sees each distinct pre-token once and its ids are remembered; the
    memory is emptied when full.
    """
    known, out = _known(path), []
    for part, special in parts(text, path):
        if special is not None:
            out.append(struct.pack("<I", special))
        else:
            out.extend(map(known.__getitem__, pretokens(part, path)))
    if end is not None:
        out.append(struct.pack("<I", end))
    return b"".join(out)
