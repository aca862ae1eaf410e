"""Hashes of the words of many texts at once, in numpy over their UTF-8 bytes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes of text handled together, unless one text is longer.
GROUP_BYTES = 1 << 17


def _random(n: int, seed: int) -> np.ndarray:
    return np.random.default_rng(seed).integers(1, 1 << 63, n, dtype=np.uint64)


class WordHasher:
    """``blank`` marks the bytes that part words (256 booleans).  A-Z count as a-z, all
    other bytes as themselves.  A word's hash is the sum of a random number per byte
    times a power by its place, mixed, modulo 2**64; it is the same in every process."""

    def __init__(self, blank: np.ndarray):
        self.blank = blank
        value = _random(256, 17)
        value[65:91] = value[97:123]
        self.value = value
        self.base = np.uint64(0x9E3779B97F4A7C15)
        self.powers = self._powers(1 << 12)

    def _powers(self, n: int) -> np.ndarray:
        return np.cumprod(np.r_[np.uint64(1), np.full(n - 1, self.base)], dtype=np.uint64)

    def words(self, data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of the words of the texts that end at ``ends`` in ``data`` (bytes), in order,
        and the number of words of each text."""
        n_texts = len(ends)
        solid = ~self.blank[data]
        start = solid.copy()
        start[1:] &= ~solid[:-1]
        firsts = np.r_[0, ends[:-1]]
        firsts = firsts[firsts < len(data)]
        start[firsts] = solid[firsts]  # a text begins a word, whatever stands before it
        at = np.flatnonzero(solid)
        if not len(at):
            return np.zeros(0, np.uint64), np.zeros(n_texts, np.int64)
        starts = np.flatnonzero(start)
        cut = np.flatnonzero(start[at])
        place = at - np.repeat(starts, np.diff(np.r_[cut, len(at)]))
        longest = int(place.max()) + 1
        if longest > len(self.powers):
            self.powers = self._powers(2 * longest)
        h = np.add.reduceat(self.value[data[at]] * self.powers[place], cut)
        counts = np.diff(np.r_[0, np.searchsorted(starts, ends)])
        return mix(h), counts


_M = np.uint64(0xD6E8FEB86659FD93)


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * _M
    x = (x ^ (x >> np.uint64(32))) * _M
    return x ^ (x >> np.uint64(32))


def groups(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Parts of a text column: (first row, bytes, end of each text in them).  Null texts are
    empty."""
    col = column.fill_null("").cast(pa.large_binary())
    if not len(col):
        return
    bounds = np.frombuffer(col.buffers()[1], np.int64)[col.offset:col.offset + len(col) + 1]
    raw = col.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None and raw.size else np.zeros(0, np.uint8)
    a = 0
    while a < len(col):
        b = int(np.searchsorted(bounds, bounds[a] + GROUP_BYTES, side="right")) - 1
        b = min(max(b, a + 1), len(col))
        yield a, data[bounds[a]:bounds[b]], bounds[a + 1:b + 1] - bounds[a]
        a = b
