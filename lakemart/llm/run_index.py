"""A run-length index of a small repetitive text, and matching statistics.

The text is a set of sequences over integers. Its Burrows-Wheeler transform is
kept as runs (head, start, LF target of the start) with the suffix-array values
at both ends of every run. Patterns stream through it from right to left, all
of them at once: a step within a run of the wanted symbol is one LF step; else
the match moves to the end of the run of that symbol before, or to the start of
the one after, whichever keeps more of it, with the sample there as its place.
"""

from __future__ import annotations

import numpy as np


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Prefix doubling; the first round sorts three symbols at once if they fit."""
    n = len(text)
    padded = np.concatenate((text + 1, [0, 0]))
    if padded.max() < 1 << 21:
        key, step = (padded[:n] << 42) | (padded[1:n + 1] << 21) | padded[2:n + 2], 3
    else:
        key, step = padded[:n], 1
    while True:
        order = np.argsort(key)               # equal keys get equal ranks, whatever their order
        sorted_key = key[order]
        rank = np.empty(n, np.int64)
        rank[order] = np.cumsum(np.concatenate(([0], sorted_key[1:] != sorted_key[:-1])))
        if rank[order[-1]] == n - 1:
            return order
        behind = np.zeros(n, np.int64)
        behind[:n - step] = rank[step:] + 1
        key = rank * (n + 1) + behind
        step *= 2


class RunIndex:
    def __init__(self, sequences: list[np.ndarray]):
        """``sequences`` over numbers from 0; each gets an end mark of its own, so
        no match reaches over an end and all suffixes differ."""
        marks = len(sequences)
        self.shift = marks
        self.text = np.concatenate([np.append(s + marks, i) for i, s in enumerate(sequences)])
        order = suffix_array(self.text)
        bwt = self.text[order - 1]
        self.start = np.flatnonzero(np.concatenate(([True], bwt[1:] != bwt[:-1])))
        length = np.diff(np.append(self.start, len(bwt)))
        self.head = bwt[self.start]
        self.end = self.start + length - 1
        self.at_start, self.at_end = order[self.start], order[self.end]
        # runs by head, then place: where they stand among the suffixes, as LF has it
        self.by_head = np.argsort(self.head, kind="stable")
        self.lf = np.empty(len(self.start), np.int64)
        self.lf[self.by_head] = np.cumsum(length[self.by_head]) - length[self.by_head]
        self.head_key = self.head[self.by_head] * len(self.start) + self.by_head
        self.padded = np.concatenate((self.text, np.full(1 << 8, -1)))

    def _common(self, a: np.ndarray, b: np.ndarray, most: np.ndarray) -> np.ndarray:
        """Symbols that the suffixes at ``a`` and ``b`` share, up to ``most``."""
        out = np.zeros(len(a), np.int64)
        live = np.flatnonzero(most > 0)
        width = 32
        cols = np.arange(width)
        last = len(self.padded) - 1
        while len(live):
            x = self.padded[np.minimum((a[live] + out[live])[:, None] + cols, last)]
            y = self.padded[np.minimum((b[live] + out[live])[:, None] + cols, last)]
            differ = x != y
            shared = np.where(differ.any(axis=1), differ.argmax(axis=1), width)
            out[live] += shared
            live = live[(shared == width) & (out[live] < most[live])]
        return np.minimum(out, most)

    def matching_statistics(self, patterns: list[np.ndarray]) -> list[np.ndarray]:
        """For every place of every pattern the length of the longest match
        that starts there."""
        sizes = np.array([len(p) for p in patterns])
        width = int(sizes.max())
        grid = np.full((len(patterns), width), -1, np.int64)
        for row, p in zip(grid, patterns, strict=True):
            row[width - len(p):] = p + self.shift
        runs = len(self.start)
        q = np.zeros(len(patterns), np.int64)           # row of the current match's suffix
        place = np.full(len(patterns), int(self.at_start[0]))
        size = np.zeros(len(patterns), np.int64)
        out = np.zeros(grid.shape, np.int64)
        for col in range(width - 1, -1, -1):
            own = np.flatnonzero(grid[:, col] >= 0)
            c = grid[own, col]
            run = np.searchsorted(self.start, q[own], "right") - 1
            inside = self.head[run] == c
            i = own[inside]
            q[i] = self.lf[run[inside]] + q[i] - self.start[run[inside]]
            place[i] -= 1
            size[i] += 1
            i, c, run = own[~inside], c[~inside], run[~inside]
            if len(i):
                after = np.searchsorted(self.head_key, c * runs + run)
                nxt = self.by_head[np.minimum(after, runs - 1)]
                prev = self.by_head[np.maximum(after - 1, 0)]
                has_next = (after < runs) & (self.head[nxt] == c)
                has_prev = (after > 0) & (self.head[prev] == c)
                has = np.concatenate((has_next, has_prev))
                kept = self._common(np.concatenate((self.at_start[nxt], self.at_end[prev])),
                                    np.tile(place[i], 2), np.where(has, np.tile(size[i], 2), 0))
                keep_next, keep_prev = np.where(has, kept, -1).reshape(2, -1)
                up = keep_prev > keep_next
                kept = np.maximum(keep_prev, keep_next)
                to = np.where(up, prev, nxt)
                found = kept >= 0
                offset = np.where(up, self.end[to] - self.start[to], 0)
                sample = np.where(up, self.at_end[to], self.at_start[to])
                q[i] = np.where(found, self.lf[to] + offset, 0)
                place[i] = np.where(found, sample - 1, int(self.at_start[0]))
                size[i] = np.where(found, kept + 1, 0)
            out[own, col] = size[own]
        return [row[width - n:] for row, n in zip(out, sizes, strict=True)]
