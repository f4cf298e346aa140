"""Run-length compressed Burrows-Wheeler index over short byte strings."""

from __future__ import annotations

import numpy as np

#: Bytes per match; three power-of-two ranks cover it (64 + 32 + 4).
LENGTH = 100


def _rank(key: np.ndarray) -> np.ndarray:
    """Each key's dense rank."""
    order = np.argsort(key)
    s = key[order]
    step = np.zeros(len(key), dtype=np.int64)
    step[1:] = s[1:] != s[:-1]
    rank = np.empty(len(key), dtype=np.int64)
    rank[order] = np.cumsum(step)
    return rank


class RunLengthIndex:
    """Index of distinct strings in a given order.

    Suffixes are sorted by prefix doubling; equal suffixes of different
    strings keep the strings' order. The transform is kept as runs (head,
    first row, mapping of the first row), with suffix-array samples at both
    ends of each run, and for every class of rows that share ``LENGTH``
    bytes the earliest position.
    """

    def __init__(self, strings: list[bytes]):
        size = np.array([len(s) for s in strings], dtype=np.int64)
        self.end = np.cumsum(size + 1) - 1  # of each string: its separator
        self.start = self.end - size
        text = np.frombuffer(b"\xff".join(strings) + b"\xff", dtype=np.uint8)
        n = len(text)
        at = np.arange(n)
        stop = np.repeat(self.end, size + 1)  # separator of the own string
        room = stop - at
        # Bytes from 1 on; the separator and what follows it are 0.
        code = np.where(text == 255, 0, text.astype(np.uint64) + np.uint64(1))
        key = np.zeros(n, dtype=np.uint64)
        for i in range(7):
            here = np.zeros(n, dtype=np.uint64)
            here[: n - i] = np.where(room[: n - i] > i, code[i:], 0)
            key = (key << np.uint64(9)) | here
        # Seven symbols of nine bits fit; doubling goes on from there.
        rank, depth, kept = _rank(key), 7, {}
        while depth < int(size.max(initial=0)) + 1:
            nxt = np.zeros(n, dtype=np.int64)
            inside = room > depth
            nxt[inside] = rank[at[inside] + depth] + 1
            rank = _rank(rank * (n + 1) + nxt)
            depth *= 2
            kept[depth] = rank
        order = np.argsort(rank * n + at)  # equal suffixes by string
        self.order = order
        before = np.where(order > 0, text[order - 1], 255)
        # Runs of the transform.
        first = np.flatnonzero(np.concatenate([[True], before[1:] != before[:-1]]))
        length = np.diff(np.concatenate([first, [n]]))
        self.run_first, self.run_head = first, before[first]
        self.sample_first, self.sample_last = order[first], order[first + length - 1]
        # Where a run's first row maps to: rows by head, separators first.
        by_head = np.lexsort((first, (self.run_head.astype(np.int64) + 1) % 256))
        self.run_to = np.empty(len(first), dtype=np.int64)
        self.run_to[by_head] = np.cumsum(length[by_head]) - length[by_head]
        self._classes(text, order, room, kept)

    def _classes(self, text, order, room, kept):
        """Rows that share ``LENGTH`` bytes, and the earliest of each class."""
        n = len(order)
        long = room[order] >= LENGTH
        same = np.zeros(n, dtype=bool)
        both = np.flatnonzero(long[1:] & long[:-1]) + 1
        a, b = order[both], order[both - 1]
        equal = np.ones(len(both), dtype=bool)
        at = 0
        for depth in sorted(kept, reverse=True):
            while at + depth <= LENGTH:
                equal &= kept[depth][a + at] == kept[depth][b + at]
                at += depth
        for i in range(at, LENGTH):
            equal &= text[a + i] == text[b + i]
        same[both] = equal
        self.class_first = np.flatnonzero(~same)
        self.class_earliest = np.minimum.reduceat(order, self.class_first) if n else order

    @property
    def runs(self) -> int:
        return len(self.run_first)

    def step(self, row: np.ndarray) -> np.ndarray:
        """Rows of the suffixes one byte longer to the left."""
        run = np.searchsorted(self.run_first, row, side="right") - 1
        return self.run_to[run] + row - self.run_first[run]

    def earlier_matches(self) -> list[np.ndarray]:
        """Stream every string from its end through the runs, all strings in
        lockstep, with the matching statistic at each byte: the earliest
        position that shares ``LENGTH`` bytes. Per string, a flag for each
        full window: does it match an earlier one?"""
        size = self.end - self.start
        flags = [np.zeros(max(0, s - LENGTH + 1), dtype=bool) for s in size]
        live = np.flatnonzero(size >= LENGTH)
        row = live.astype(np.int64)  # the separators' rows come first, in order
        flat = np.concatenate(flags) if flags else np.zeros(0, dtype=bool)
        base = np.cumsum([0] + [len(f) for f in flags])
        for t in range(1, int(size.max(initial=0)) + 1):
            go = size[live] >= t
            live, row = live[go], row[go]
            if not len(live):
                break
            row = self.step(row)
            if t >= LENGTH:
                at = size[live] - t
                earliest = self.class_earliest[np.searchsorted(self.class_first, row, side="right") - 1]
                flat[base[live] + at] = earliest < self.start[live] + at
        return [flat[a:b] for a, b in zip(base[:-1], base[1:])]
