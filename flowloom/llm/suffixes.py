"""Suffix arrays in numpy: Larsson-Sadakane refinement and Kasai's common prefixes, for many short texts at once."""

from __future__ import annotations

import numpy as np

_PAD = 8


class Suffixes:
    """The suffixes of several byte texts in order, equal ones by place.

    UTF-8 has no byte above 0xF7, so each byte plus one fits into a byte and 0 ends a text; a suffix that ends sorts
    before one that goes on.
    """

    def __init__(self, texts: list[bytes]):
        self.lengths = np.array([len(t) for t in texts], np.int64)
        padded = b"".join(t + b"\xff" * _PAD for t in texts)
        self.data = np.frombuffer(padded, np.uint8) + np.uint8(1)
        self.begins = np.cumsum(self.lengths + _PAD) - (self.lengths + _PAD)
        ends = np.repeat(self.begins + self.lengths, self.lengths + _PAD)
        #: Bytes from each place to the end of its text; none in the padding.
        self.left = np.maximum(ends - np.arange(len(self.data)), 0)
        self.eights = self._eights()
        self.order, self.rank = self._sorted()

    def _eights(self) -> np.ndarray:
        """The next eight bytes from each place as one number."""
        keys, size = self.data.astype(np.uint64), 1
        while size < _PAD:
            ahead = np.zeros_like(keys)
            ahead[:-size] = keys[size:]
            keys = (keys << np.uint64(8 * size)) | ahead
            size *= 2
        return keys

    def _sorted(self) -> tuple[np.ndarray, np.ndarray]:
        """Doubling goes on to the longest text: Kasai's walk needs the whole order."""
        depth = int(self.lengths.max(initial=0))
        places = np.flatnonzero(self.left)
        order = places[np.argsort(self.eights[places], kind="stable")]
        rank = np.zeros(len(self.data), np.int64)
        slots = np.arange(len(order))
        opens = self._opens(self.eights[order])
        # A group's rank is its first slot plus one, so 0 stands for a suffix that has ended.
        heads = np.maximum.accumulate(np.where(opens, slots, 0))
        rank[order] = heads + 1
        done = _PAD
        todo = self._unsorted(opens)
        while done < depth and len(todo):
            members = order[todo]
            ahead = np.minimum(members + done, len(self.data) - 1)
            second = np.where(done < self.left[members], rank[ahead], 0)
            keys = rank[members] * (len(order) + 2) + second
            moved = np.argsort(keys, kind="stable")
            order[todo], keys = members[moved], keys[moved]
            opens = self._opens(keys)
            heads = np.maximum.accumulate(np.where(opens, todo, 0))
            rank[order[todo]] = heads + 1
            todo = todo[self._unsorted(opens)]
            done *= 2
        rank[order] = slots + 1
        return order, rank

    @staticmethod
    def _opens(keys: np.ndarray) -> np.ndarray:
        opens = np.ones(len(keys), bool)
        opens[1:] = keys[1:] != keys[:-1]
        return opens

    @staticmethod
    def _unsorted(opens: np.ndarray) -> np.ndarray:
        """Members of groups of two or more."""
        last = np.ones(len(opens), bool)
        last[:-1] = opens[1:]
        return np.flatnonzero(~(opens & last))

    def common(self, depth: int) -> np.ndarray:
        """Per place: bytes its suffix shares with the one before it in order, up to `depth`.

        Kasai's walk: from one place to the next in a text, what is shared shrinks by one at most. All texts walk
        side by side, as far as suffixes of `depth` bytes begin; shorter ones share 0 here.
        """
        shared = np.zeros(len(self.data), np.int64)
        held = np.zeros(len(self.begins), np.int64)
        steps = np.maximum(self.lengths - depth + 1, 0)
        lanes = np.flatnonzero(steps)
        for step in range(int(steps.max(initial=0))):
            lanes = lanes[steps[lanes] > step]
            here = self.begins[lanes] + step
            slot = self.rank[here] - 1
            there = self.order[np.maximum(slot - 1, 0)]
            limit = np.where(slot > 0, np.minimum(np.minimum(self.left[here], self.left[there]), depth), 0)
            now = np.minimum(np.maximum(held[lanes] - 1, 0), limit)
            live = np.flatnonzero(now < limit)
            while len(live):
                a, b = here[live] + now[live], there[live] + now[live]
                differ = self.eights[a] ^ self.eights[b]
                # Equal leading bytes: those above the highest one that differs.
                same = sum((differ < (np.uint64(1) << np.uint64(8 * k))).astype(np.int64) for k in range(_PAD))
                now[live] = np.minimum(now[live] + same, limit[live])
                live = live[(same >= _PAD) & (now[live] < limit[live])]
            shared[here], held[lanes] = now, now
        return shared

    def repeated(self, depth: int) -> list[np.ndarray]:
        """Per text: the places whose first `depth` bytes also begin at another place of these texts."""
        shared = self.common(depth) >= depth
        found = np.zeros(len(self.data), bool)
        found[shared] = True
        found[self.order[self.rank[np.flatnonzero(shared)] - 2]] = True
        return [np.flatnonzero(found[b : b + n]) for b, n in zip(self.begins, self.lengths, strict=True)]
