"""A run-length index of a collection of short texts: run-compressed Burrows-Wheeler transform with
sampled run ends, and matching statistics streamed through it.

The collection is a shard's repeated contexts (see ``suffixdedup``), a megabyte or so at a time. All
steps are vector operations over the shard; texts are streamed side by side, one byte each a step.
"""

from __future__ import annotations

import numpy as np

_ROW = np.uint64(40)


class RunLengthIndex:
    """``text`` holds the contexts one after another, context j is ``text[offsets[j]:offsets[j + 1]]``."""

    def __init__(self, text: np.ndarray, offsets: np.ndarray, match: int) -> None:
        m = len(offsets) - 1
        size = np.diff(offsets)
        self.match, self.size = match, size
        self.begin = offsets[:-1] + np.arange(m)  # each context is followed by an end symbol, 0
        n = len(text) + m
        self.owner = np.repeat(np.arange(m), size + 1)
        self.end = (self.begin + size)[self.owner]
        symbols = np.zeros(n + 8, np.uint64)
        ends = self.begin + size
        body = np.ones(n, bool)
        body[ends] = False
        symbols[:n][body] = text.astype(np.uint64) + np.uint64(1)
        self.symbols = symbols[:n].astype(np.int64)
        order, depth_rank = self._suffixes(symbols, n)
        before = np.where(order == self.begin[self.owner[order]], 0, self.symbols[order - 1])
        cut = np.flatnonzero(np.append(True, before[1:] != before[:-1]))
        length = np.diff(np.append(cut, n))
        char = before[cut]
        by_char = np.lexsort((cut, char))
        self.runs = len(cut)
        self.run_char, self.run_start, self.run_length = char[by_char], cut[by_char], length[by_char]
        self.run_key = (self.run_char.astype(np.uint64) << _ROW) | self.run_start.astype(np.uint64)
        self.sample = order[cut + length - 1][by_char]  # text position at each run's last row
        # rows of suffixes below a run's character, then of the same character in earlier runs
        counts = np.bincount(self.symbols, minlength=257)
        below = np.cumsum(counts) - counts
        same = np.cumsum(self.run_length) - self.run_length
        first = np.searchsorted(self.run_char, np.arange(257))
        self.rank_before = below[self.run_char] + same - same[np.minimum(first[self.run_char], len(same) - 1)]
        self.rows, self.last = n, int(order[-1])
        # rows whose suffixes agree in ``match`` symbols stand together; where a group of them begins
        rank, depth = depth_rank
        far = np.minimum(order + match - depth, self.end[order])
        whole = self.end[order] - order >= match
        agree = (rank[order][1:] == rank[order][:-1]) & (rank[far][1:] == rank[far][:-1]) & whole[1:] & whole[:-1]
        self.group_start = np.flatnonzero(np.append(True, ~agree))
        self._rank, self._depth = rank, depth

    def _suffixes(self, symbols: np.ndarray, n: int) -> tuple[np.ndarray, tuple[np.ndarray, int]]:
        """The suffix order by prefix doubling, and the ranks by the longest prefix of at most ``match`` symbols met on the way."""
        depth = 7
        key = np.zeros(n, np.uint64)
        open_ = np.ones(n, bool)
        at = np.arange(n)
        for j in range(depth):
            key <<= np.uint64(9)
            key |= np.where(open_, symbols[j : n + j], np.uint64(0))
            open_ &= at + j < self.end
        kept = None
        while True:
            order = np.argsort(key)
            new = np.append(False, key[order][1:] != key[order][:-1])
            rank = np.empty(n, np.int64)
            rank[order] = np.cumsum(new)
            if depth <= self.match:
                kept = (rank, depth)
            if rank[order[-1]] == n - 1 and depth * 2 > self.match:
                return order, kept
            # a suffix that ended within ``depth`` symbols ties only with such as end alike: the context decides
            after = np.where(at + depth <= self.end, rank[np.minimum(at + depth, n - 1)], self.owner)
            key = rank.astype(np.uint64) * np.uint64(n) + after.astype(np.uint64)
            depth *= 2

    def stream(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Matching statistics of the contexts themselves, read from their ends.

        Gives, for each start with at least ``match`` symbols to its context's end, the start (text
        position), the row group of its first ``match`` symbols and, from the sampled run ends, a text
        position where they stand.
        """
        by_size = np.argsort(-self.size, kind="stable")
        begin, size = self.begin[by_size], self.size[by_size]
        high = np.full(len(size), self.rows, np.int64)  # one past the last row that begins with what has been read
        held = np.full(len(size), self.last, np.int64)  # the text position of that last row
        starts, groups, located = [], [], []
        active = np.searchsorted(-size, -np.arange(int(size.max(initial=0))), side="left")
        for step in range(int(size.max(initial=0))):
            k = int(active[step])
            at = begin[:k] + size[:k] - 1 - step
            symbol = self.symbols[at].astype(np.uint64)
            h = high[:k]
            run = np.searchsorted(self.run_key, (symbol << _ROW) | h.astype(np.uint64)) - 1
            within = h - self.run_start[run]
            inside = within <= self.run_length[run]
            held[:k] = np.where(inside, held[:k], self.sample[run]) - 1
            high[:k] = self.rank_before[run] + np.minimum(within, self.run_length[run])
            if step + 1 >= self.match:
                starts.append(at)
                groups.append(np.searchsorted(self.group_start, high[:k] - 1, side="right") - 1)
                located.append(held[:k].copy())
        empty = [np.zeros(0, np.int64)]
        return np.concatenate(starts or empty), np.concatenate(groups or empty), np.concatenate(located or empty)

    def same(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether the ``match`` symbols from a and from b are equal, exactly."""
        far = self.match - self._depth
        return (self._rank[a] == self._rank[b]) & (self._rank[a + far] == self._rank[b + far])

    def repeats(self) -> tuple[np.ndarray, np.ndarray]:
        """(context, first symbol) of every start whose ``match`` symbols also start in an earlier context."""
        start, group, located = self.stream()
        assert self.same(start, located).all()
        first = np.full(len(self.group_start), self.rows, np.int64)
        np.minimum.at(first, group, start)
        again = start[first[group] < start]
        return self.owner[again], again - self.begin[self.owner[again]]
