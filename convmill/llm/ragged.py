"""Lists of different lengths as one flat array with their counts."""

from __future__ import annotations

import numpy as np


def before(counts: np.ndarray) -> np.ndarray:
    """The sum of the counts before each one."""
    return np.cumsum(counts) - counts


def picked(flat: np.ndarray, starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The lists ``flat[start : start + count]``, one after the other."""
    return flat[np.repeat(starts - before(counts), counts) + np.arange(int(counts.sum()))]


class Pool:
    """Lists that are added in blocks and looked up by number; room doubles as it fills up."""

    def __init__(self, dtype: str) -> None:
        self.flat, self.used = np.zeros(1024, dtype), 0
        self.starts, self.counts, self.lists = np.zeros(256, np.int64), np.zeros(256, np.int64), 0

    def add(self, flat: np.ndarray, counts: np.ndarray) -> None:
        while self.used + len(flat) > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
        while self.lists + len(counts) > len(self.counts):
            self.starts, self.counts = (np.concatenate([x, np.zeros_like(x)]) for x in (self.starts, self.counts))
        self.flat[self.used : self.used + len(flat)] = flat
        self.starts[self.lists : self.lists + len(counts)] = self.used + before(counts)
        self.counts[self.lists : self.lists + len(counts)] = counts
        self.used, self.lists = self.used + len(flat), self.lists + len(counts)

    def of(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The lists of these numbers in turn, and their counts."""
        counts = self.counts[numbers]
        return picked(self.flat, self.starts[numbers], counts), counts


#: Decimal digits of an unsigned 32-bit number, at most.
_DIGITS = 10


def spelled(ids: np.ndarray, marks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each id in decimal, followed by its mark (a byte; 0: none): all bytes, and how many each id takes."""
    width = len(str(int(ids.max()))) if len(ids) else 1
    out = np.zeros((len(ids), min(width, _DIGITS) + 1), np.uint8)
    rest = ids.astype(np.uint32)
    for k in range(out.shape[1] - 2, -1, -1):
        digit = rest % 10
        # Zeros before the first digit are left out; the last digit always stands.
        out[:, k] = np.where((rest > 0) | (k == out.shape[1] - 2), digit + 48, 0)
        rest //= 10
    out[:, -1] = marks
    kept = out != 0
    return out[kept], kept.sum(axis=1)
