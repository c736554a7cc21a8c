"""A run-length index of a collection of short texts: the runs of its Burrows-Wheeler transform, sampled at their ends."""

from __future__ import annotations

import numpy as np


class RunLengthIndex:
    """Texts are sorted by suffix; the symbols before the suffixes, in that order, form runs.

    Kept for each run: its symbol and length, the text position of its first suffix, that suffix's predecessor
    in suffix order (the last of the run before) and how many bytes the two share. All else follows: within a
    run, a position's predecessor is one beyond that of the position before it, and shares one byte less.
    """

    def __init__(self, data: np.ndarray, lengths: np.ndarray):
        """data: the texts' bytes one after another; lengths: of each text."""
        self.lengths = np.asarray(lengths, np.int64)
        ends = np.cumsum(self.lengths + 1)
        size = int(ends[-1]) if len(ends) else 0
        symbols = np.zeros(size, np.int64)  # 0 ends a text
        inside = np.ones(size, bool)
        inside[ends - 1] = False
        symbols[inside] = data.astype(np.int64) + 1
        where = np.arange(size)
        self.left = np.repeat(ends - 1, self.lengths + 1) - where  # bytes from here to the text's end
        order = self._sorted(symbols)
        before = symbols[order - 1] if size else symbols
        head = np.ones(size, bool)
        head[1:] = (before[1:] != before[:-1]) | (before[1:] == 0)
        at = np.flatnonzero(head)
        self.symbol, self.run = before[at], np.diff(np.append(at, size))
        self.sample = order[at]
        self.previous = np.where(at > 0, order[at - 1], -1)
        self.shared = self._common(symbols, self.sample, self.previous)

    def _sorted(self, symbols: np.ndarray) -> np.ndarray:
        """Suffix order by prefix doubling; suffixes that end alike stand in order of position."""
        size, step = len(symbols), 6
        if not size:
            return np.empty(0, np.int64)
        key = np.zeros(size, np.int64)
        for k in range(step):
            part = np.zeros(size, np.int64)
            part[: size - k] = symbols[k:]
            key = key << 9 | np.where(self.left >= k, part, 0)
        while True:
            order = np.argsort(key, kind="stable")
            fresh = np.append(True, key[order][1:] != key[order][:-1])
            rank = np.empty(size, np.int64)
            rank[order] = np.cumsum(fresh) - 1
            if fresh.all():
                return order
            after = np.arange(size)  # a suffix that ended is told by its place
            going = self.left >= step
            after[going] = size + rank[np.flatnonzero(going) + step]
            key = rank * (2 * size) + after
            step *= 2

    def _common(self, symbols: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Bytes that the suffixes at a and b share; 0 where b is -1."""
        most = np.where(b >= 0, np.minimum(self.left[a], self.left[b]), 0)
        out, alive = np.zeros(len(a), np.int64), np.flatnonzero(most)
        while len(alive):
            n = out[alive]
            same = symbols[a[alive] + n] == symbols[b[alive] + n]
            alive = alive[same]
            out[alive] += 1
            alive = alive[out[alive] < most[alive]]
        return out

    def matching_statistics(self) -> tuple[np.ndarray, np.ndarray]:
        """(predecessor, bytes shared with it) of every position, streamed in text order from the sampled run ends."""
        size = len(self.left)
        place = np.argsort(self.sample)
        sample = self.sample[place]
        run = np.searchsorted(sample, np.arange(size), side="right") - 1
        gone = np.arange(size) - sample[run]
        shared = np.maximum(self.shared[place][run] - gone, 0)
        return np.where(shared > 0, self.previous[place][run] + gone, -1), shared

    def classes(self, length: int) -> np.ndarray:
        """For each position, one position of those at which the same string of that length starts; itself if none else does."""
        previous, shared = self.matching_statistics()
        root = np.where(shared >= length, previous, np.arange(len(shared)))
        while True:
            further = root[root]
            if (further == root).all():
                return root
            root = further
