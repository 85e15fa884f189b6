"""Words of many texts at once, as numpy arrays: where they are and a 64-bit hash of each."""

from __future__ import annotations

import functools

import numpy as np

# The bytes that separate words. In UTF-8 they are never part of another character.
SEPARATORS = (0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_BLOCK = 1 << 20


def mixed(values: np.ndarray) -> np.ndarray:
    """A bijection that spreads every bit of 64-bit values over all of them."""
    values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


@functools.cache
def byte_codes(lower: bool) -> np.ndarray:
    """A 64-bit code of each byte; separators count 0; with `lower`, A-Z count as a-z."""
    codes = mixed(np.arange(1, 257, dtype=np.uint64) * _BASE)
    codes[list(SEPARATORS)] = 0
    if lower:
        codes[ord("A") : ord("Z") + 1] = codes[ord("a") : ord("z") + 1]
    return codes


@functools.cache
def _separator_table() -> np.ndarray:
    table = np.zeros(256, bool)
    table[list(SEPARATORS)] = True
    return table


def powers(n: int) -> np.ndarray:
    """Powers of the base, at least n of them."""
    size = 1 << max(10, int(n - 1).bit_length())
    return _powers(size) if size <= 1 << 16 else _powers.__wrapped__(size)


@functools.cache
def _powers(n: int) -> np.ndarray:
    out = np.full(n, _BASE, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def word_hashes(data: np.ndarray, offsets: np.ndarray, lower: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of all texts in order, and how many words each text has.

    `data` holds the bytes of the texts one after the other, `offsets` where each begins and the last ends. Works
    through blocks of texts, so what it needs besides its result does not grow with the batch, only with its longest word.
    """
    hashes, counts = [np.zeros(0, np.uint64)], np.zeros(len(offsets) - 1, np.int64)
    first = 0
    while first < len(counts):
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + _BLOCK, side="right")) - 1)
        begin = int(offsets[first])
        found, starts = _hash_block(data[begin : int(offsets[last])], offsets[first : last + 1] - begin, lower)
        hashes.append(found)
        counts[first:last] = np.diff(np.searchsorted(starts, offsets[first : last + 1] - begin))
        first = last
    return np.concatenate(hashes), counts


def _hash_block(data: np.ndarray, offsets: np.ndarray, lower: bool) -> tuple[np.ndarray, np.ndarray]:
    if not len(data):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    apart = _separator_table()[data]
    opens = np.empty(len(data), bool)
    opens[0] = True
    opens[1:] = apart[:-1]
    opens[offsets[:-1][offsets[:-1] < len(data)]] = True
    opens &= ~apart
    starts = np.flatnonzero(opens)
    if not len(starts):
        return np.zeros(0, np.uint64), starts
    codes = byte_codes(lower)[data[starts[0] :]]
    # Place of each byte in its word; what separates words counts 0 and may have any place.
    lengths = np.diff(starts, append=len(data))
    places = np.arange(len(codes)) - np.repeat(starts - starts[0], lengths)
    codes *= powers(int(lengths.max()))[places]
    return mixed(np.add.reduceat(codes, starts - starts[0])), starts


def rolled(values: np.ndarray, width: int, seed: int = 1) -> np.ndarray:
    """A hash of each run of `width` neighbours, by doubling: about 2 log(width) passes and no table."""
    base = mixed(np.array([seed], np.uint64))[0] | np.uint64(1)
    if len(values) < width:
        return np.zeros(0, np.uint64)
    out, done, step, size, factor = None, 0, values, 1, base
    power = np.uint64(1)
    left = width
    with np.errstate(over="ignore"):
        while left:
            if left & 1:
                piece = step[done:]
                if out is None:
                    out, power = piece, factor
                else:
                    n = min(len(out), len(piece))
                    out, power = out[:n] + piece[:n] * power, power * factor
                done += size
            left >>= 1
            if left:
                step = step[: len(step) - size] + step[size:] * factor
                factor = factor * factor
                size *= 2
    return mixed(out)


def doc_of(counts: np.ndarray) -> np.ndarray:
    """Which text each of its words belongs to."""
    return np.repeat(np.arange(len(counts)), counts)
