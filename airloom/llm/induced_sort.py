"""Suffix array of a byte text by induced sorting, bucket by bucket, with queues that spill to disk.

Suffixes are S (smaller than the next one) or L (larger). The leftmost S suffixes are sorted first,
by the names of the pieces between them; all others are induced: a queue holds, per first byte,
suffixes in ascending order, and each one taken out puts the suffix before it into its own byte's
queue. Whole waves of a queue are handled at once.
"""

from __future__ import annotations

import tempfile

import numpy as np


class Queues:
    """First-in first-out queues of positions by byte; beyond ``limit`` bytes in memory they go to disk."""

    def __init__(self, limit: int):
        self.limit, self.held = limit, 0
        self.parts: list[list] = [[] for _ in range(257)]
        self.file = None

    def put(self, byte: int, positions: np.ndarray) -> None:
        if self.held + positions.nbytes > self.limit:
            self.file = self.file or tempfile.TemporaryFile()
            self.file.seek(0, 2)
            self.parts[byte].append((self.file.tell(), len(positions)))
            positions.tofile(self.file)
        else:
            self.held += positions.nbytes
            self.parts[byte].append(positions)

    def spread(self, bytes_of: np.ndarray, positions: np.ndarray) -> None:
        """Put every position into the queue of its byte, in the given order."""
        if not len(positions):
            return
        order = np.argsort(bytes_of, kind="stable")
        sorted_bytes = bytes_of[order]
        cuts = np.flatnonzero(sorted_bytes[1:] != sorted_bytes[:-1]) + 1
        for part in np.split(order, cuts):
            self.put(int(bytes_of[part[0]]), positions[part])

    def take(self, byte: int) -> np.ndarray:
        out = []
        for part in self.parts[byte]:
            if isinstance(part, tuple):
                self.file.seek(part[0])
                part = np.fromfile(self.file, np.int32, part[1])
            else:
                self.held -= part.nbytes
            out.append(part)
        self.parts[byte] = []
        return np.concatenate(out) if out else np.zeros(0, np.int32)

    def close(self) -> None:
        if self.file:
            self.file.close()


def _induce(text: np.ndarray, is_s: np.ndarray, lms: np.ndarray, limit: int) -> np.ndarray:
    """The suffixes in order, given the leftmost S ones in order (the empty end comes first)."""
    n = len(text)
    seeds = Queues(limit)
    seeds.spread(text[lms], lms)
    queue = Queues(limit)
    if n and not is_s[n - 1]:
        queue.put(int(text[n - 1]), np.array([n - 1], np.int32))  # put there by the empty suffix
    large: list[np.ndarray] = [np.zeros(0, np.int32)] * 257
    for c in range(257):
        waves, wave = [], queue.take(c)
        while len(wave):
            waves.append(wave)
            before = wave[wave > 0] - 1
            before = before[~is_s[before]]
            own = text[before] == c
            queue.spread(text[before[~own]], before[~own])
            wave = before[own]
        large[c] = np.concatenate(waves) if waves else large[c]
        wave = seeds.take(c)
        before = wave[wave > 0] - 1
        before = before[~is_s[before]]
        queue.spread(text[before], before)
    queue.close(), seeds.close()
    queue = Queues(limit)
    out: list[np.ndarray] = []
    for c in range(256, -1, -1):
        waves, wave = [], queue.take(c)
        while len(wave):
            waves.append(wave)
            before = wave[wave > 0] - 1
            before = before[is_s[before]]
            own = text[before] == c
            queue.spread(text[before[~own]], before[~own])
            wave = before[own]
        down = large[c][::-1]
        out += [*waves, down]
        before = down[down > 0] - 1
        before = before[is_s[before]]
        queue.spread(text[before], before)
    queue.close()
    return np.concatenate(out)[::-1] if out else np.zeros(0, np.int32)


def _rank(text: np.ndarray, lms: np.ndarray, depth: int) -> np.ndarray:
    """The leftmost S suffixes in order of their first ``depth`` bytes at least.

    Eight bytes at a time: suffixes that are equal so far are a group, and a group is sorted by its next eight bytes.
    """
    padded = np.zeros(len(text) + depth + 16, np.uint8)
    padded[: len(text)] = text
    words = np.lib.stride_tricks.as_strided(padded.view(np.uint8), (len(padded) - 7, 8), (1, 1))
    order, todo = np.arange(len(lms)), np.arange(len(lms))
    group = np.zeros(len(lms), np.int64)  # number of the suffixes that are equal so far, in order
    for at in range(0, depth, 8):
        if not len(todo):
            break
        key = words[lms[order[todo]] + at].copy().view(">u8").ravel().astype(np.uint64)
        first = np.argsort(key)
        rank = np.empty(len(key), np.int64)
        rank[first] = np.cumsum(np.append(False, key[first[1:]] != key[first[:-1]]))
        both = group * (len(key) + 1) + rank  # one number to sort by: group, then the next eight bytes
        sort = np.argsort(both)
        order[todo] = order[todo[sort]]
        both = both[sort]
        new = np.append(True, both[1:] != both[:-1])
        open_ = ~(new & np.append(new[1:], True))
        group, todo = np.cumsum(new)[open_], todo[open_]
    return lms[order]


def suffix_array(text: np.ndarray, depth: int, limit: int = 256 << 20) -> np.ndarray:
    """Start positions in order; suffixes whose first ``depth`` bytes are equal are neighbours, in
    any order among themselves. ``limit``: bytes that a set of queues may hold in memory."""
    n = len(text)
    if n < 2:
        return np.arange(n, dtype=np.int32)
    symbol = text.astype(np.int16) + 1
    # S or L by the next byte that differs; the last suffix is L.
    differs = np.append(symbol[1:] != symbol[:-1], True)
    nxt = np.where(differs, np.arange(n), n)
    nxt = np.minimum.accumulate(nxt[::-1])[::-1]
    after = np.append(symbol, 0)[nxt + 1]
    is_s = symbol < after
    lms = (np.flatnonzero(is_s[1:] & ~is_s[:-1]) + 1).astype(np.int32)
    return _induce(symbol, is_s, _rank(text, lms, depth), limit)
