"""Counting quotient filters: lossless sorted counters of packed pairs of ids.

A pair of ids of ``half`` bits each is permuted invertibly (a Feistel network), so that the
keys are spread evenly whatever the ids are.  The key's high bits are its quotient, which
isn't stored (a filter only counts the keys of each quotient); the low bits are its full
remainder, so nothing is lost.  Counters take one byte, larger ones an entry of their own.
Filters are sorted by key: merging some is merging sorted runs.
"""

from __future__ import annotations

import struct
from collections.abc import Sequence

import numpy as np

from partsmith.llm.wordhash import mix

_ROUNDS = [np.uint64(c) for c in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9,
                                  0x27D4EB2F165667C5)]
MAX_HALF = 32


def half_bits(ids: int) -> int:
    """Bits for ids below ``ids``."""
    bits = max(1, int(ids - 1).bit_length())
    if bits > MAX_HALF:
        raise ValueError("more than 2**32 frequent phrases of one length don't fit a packed pair")
    return bits


def permute(first: np.ndarray, second: np.ndarray, half: int) -> np.ndarray:
    """Keys (uint64 of ``2 * half`` bits) of pairs of ids."""
    mask = np.uint64((1 << half) - 1)
    a, b = first.astype(np.uint64), second.astype(np.uint64)
    for c in _ROUNDS:
        a, b = b, a ^ (mix(b + c) & mask)
    return (a << np.uint64(half)) | b


def invert(keys: np.ndarray, half: int) -> tuple[np.ndarray, np.ndarray]:
    """The pairs of ids behind ``keys``."""
    mask = np.uint64((1 << half) - 1)
    a, b = keys >> np.uint64(half), keys & mask
    for c in reversed(_ROUNDS):
        a, b = b ^ (mix(a + c) & mask), a
    return a.astype(np.int64), b.astype(np.int64)


def _narrowest(bits: int) -> type:
    return next(t for t, n in ((np.uint8, 8), (np.uint16, 16), (np.uint32, 32), (np.uint64, 64))
                if bits <= n)


_HEAD = "<QBBBQ"


class QuotientFilter:
    """Counts of distinct ``bits``-bit keys."""

    def __init__(self, bits: int, q: int, runs: np.ndarray, remainders: np.ndarray,
                 small: np.ndarray, large: np.ndarray):
        self.bits, self.q, self.runs, self.remainders = bits, q, runs, remainders
        self.small, self.large = small, large

    @classmethod
    def build(cls, keys: np.ndarray, counts: np.ndarray, bits: int) -> QuotientFilter:
        """From sorted distinct keys and their counts."""
        n = len(keys)
        q = min(bits, max(0, n.bit_length() - 1))
        rest = bits - q
        quotient = (keys >> np.uint64(rest)) if q else np.zeros(n, np.uint64)
        low = keys if rest >= 64 else keys & np.uint64((1 << rest) - 1)
        runs = np.bincount(quotient.astype(np.int64), minlength=1 << q)
        counts = counts.astype(np.uint64)
        return cls(bits, q, runs.astype(_narrowest(int(runs.max(initial=0)).bit_length())),
                   low.astype(_narrowest(rest)), np.minimum(counts, 255).astype(np.uint8),
                   counts[counts >= 255])

    def keys(self) -> np.ndarray:
        quotient = np.repeat(np.arange(1 << self.q, dtype=np.uint64), self.runs)
        low = self.remainders.astype(np.uint64)
        return (quotient << np.uint64(self.bits - self.q)) | low if self.q else low

    def counts(self) -> np.ndarray:
        out = self.small.astype(np.uint64)
        out[self.small == 255] = self.large
        return out.astype(np.int64)

    def __len__(self) -> int:
        return len(self.remainders)

    def pack(self) -> bytes:
        head = struct.pack(_HEAD, len(self), self.bits, self.q, self.runs.itemsize, len(self.large))
        return b"".join([head, self.runs.tobytes(), self.remainders.tobytes(),
                         self.small.tobytes(), self.large.tobytes()])

    @classmethod
    def unpack(cls, blob: bytes) -> QuotientFilter:
        n, bits, q, run_size, n_large = struct.unpack_from(_HEAD, blob)
        at, out = struct.calcsize(_HEAD), []
        for kind, length in ((np.dtype(f"u{run_size}"), 1 << q), (_narrowest(bits - q), n),
                             (np.uint8, n), (np.uint64, n_large)):
            out.append(np.frombuffer(blob, kind, length, at))
            at += out[-1].nbytes
        return cls(bits, q, *out)


def merge(filters: Sequence[QuotientFilter]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Sorted distinct keys of some filters and their summed counts; and for every entry of the
    filters, one after the other, its key and the place of that key."""
    keys = np.concatenate([f.keys() for f in filters])
    counts = np.concatenate([f.counts() for f in filters])
    order = np.argsort(keys, kind="stable")  # sorted runs are merged
    ordered = keys[order]
    new = np.r_[True, ordered[1:] != ordered[:-1]][:len(keys)]
    place = np.empty(len(keys), np.int64)
    place[order] = np.cumsum(new) - 1
    totals = np.add.reduceat(counts[order], np.flatnonzero(new)) if len(keys) else counts
    return ordered[new], totals, keys, place
