"""Merges of many short symbol sequences side by side."""

from __future__ import annotations

import numpy as np

_NONE = np.iinfo(np.int32).max


class PairTable:
    """Ranks of symbol pairs and what they merge to, for arrays of pairs."""

    def __init__(self, ranks: dict[tuple[int, int], tuple[int, int]]):
        pairs = np.array(list(ranks), np.int64).reshape(-1, 2)
        values = np.array(list(ranks.values()), np.int32).reshape(-1, 2)
        keys = pairs[:, 0] << 32 | pairs[:, 1]
        order = np.argsort(keys)
        # One entry behind the last, so that a search never ends outside.
        self.keys = np.append(keys[order], np.iinfo(np.int64).max)
        self.ranks, self.both = np.append(values[order, 0], _NONE), np.append(values[order, 1], -1)

    def find(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The entry of each pair; the last one where there is none."""
        wanted = left.astype(np.int64) << 32 | right
        at = np.searchsorted(self.keys, wanted)
        return np.where(self.keys[at] == wanted, at, len(self.keys) - 1)

    def merged(self, symbols: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The tokens of all sequences (none empty), one behind the other, and how many each has.

        In each round every sequence merges its pairs of lowest rank, from the left; finished sequences leave.
        """
        none = len(self.keys) - 1
        tokens, owner = symbols.astype(np.int64), np.repeat(np.arange(len(sizes)), sizes)
        done_tokens, done_owner = [], []
        entry = self._entries(tokens, owner)
        while len(tokens):
            begins = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
            ranks = self.ranks[entry]
            lengths = np.diff(begins, append=len(owner))
            least = np.repeat(np.minimum.reduceat(ranks, begins), lengths)
            open_ones = least != _NONE
            if not open_ones.all():
                done_tokens.append(tokens[~open_ones])
                done_owner.append(owner[~open_ones])
                tokens, owner, entry = tokens[open_ones], owner[open_ones], entry[open_ones]
                ranks, least = ranks[open_ones], least[open_ones]
                if not len(tokens):
                    break
            hit = ranks == least
            # Of pairs of one rank that overlap, the first, third, ... of each chain.
            at = np.flatnonzero(hit)
            chain = np.concatenate([[True], at[1:] != at[:-1] + 1])
            first = np.maximum.accumulate(np.where(chain, np.arange(len(at)), 0))
            at = at[(np.arange(len(at)) - first) % 2 == 0]
            tokens[at] = self.both[entry[at]]
            keep = np.ones(len(tokens), bool)
            keep[at + 1] = False
            # New places of the merged tokens; only pairs beside them have changed.
            place = (np.cumsum(keep) - 1)[at]
            tokens, owner, entry = tokens[keep], owner[keep], entry[keep]
            changed = np.unique(np.concatenate([place, np.maximum(place - 1, 0)]))
            inner = changed[changed + 1 < len(tokens)]
            found = np.where(owner[inner] == owner[inner + 1], self.find(tokens[inner], tokens[inner + 1]), none)
            entry[changed[changed + 1 >= len(tokens)]] = none
            entry[inner] = found
        if not done_tokens:
            return np.zeros(0, np.int64), np.zeros(len(sizes), np.int64)
        tokens, owner = np.concatenate(done_tokens), np.concatenate(done_owner)
        order = np.argsort(owner, kind="stable")
        return tokens[order], np.bincount(owner, minlength=len(sizes))

    def _entries(self, tokens: np.ndarray, owner: np.ndarray) -> np.ndarray:
        entry = np.full(len(tokens), len(self.keys) - 1)
        inside = np.flatnonzero(owner[1:] == owner[:-1])
        entry[inside] = self.find(tokens[inside], tokens[inside + 1])
        return entry
