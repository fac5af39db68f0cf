"""Monotone sequences in Elias-Fano form, read without unpacking them."""

from __future__ import annotations

import numpy as np

_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little")
_ONES = _BITS.sum(axis=1).astype(np.int64)
# place of the k-th one of a byte
_PLACE = np.zeros((256, 8), np.int64)
for _b in range(256):
    _PLACE[_b, :_ONES[_b]] = np.flatnonzero(_BITS[_b])


class EliasFano:
    """``n`` numbers that never fall: low bits packed, high parts in unary, one bit each and one
    per step. Access by index and search for the first number not below a value work on arrays."""

    def __init__(self, n: int, low_bits: int, low: np.ndarray, high: np.ndarray):
        self.n, self.low_bits, self.low, self.high = n, low_bits, low, high
        ones = np.bitwise_count(self.high).astype(np.int64)
        self._ones = np.concatenate(([0], np.cumsum(ones)))
        self._zeros = np.arange(len(self._ones)) * 64 - self._ones

    @classmethod
    def build(cls, values: np.ndarray) -> EliasFano:
        """Values are unsigned and below 2^63."""
        values = np.asarray(values, np.uint64)
        n = len(values)
        top = int(values[-1]) + 1 if n else 1
        bits = max((top // max(n, 1)).bit_length() - 1, 0)
        low = np.zeros(n * bits // 64 + 2, np.uint64)
        if bits:
            part = values & np.uint64((1 << bits) - 1)
            at = np.arange(n, dtype=np.int64) * bits
            word, shift = at >> 6, (at & 63).astype(np.uint64)
            np.bitwise_or.at(low, word, part << shift)
            over = shift + np.uint64(bits) > 64
            np.bitwise_or.at(low, word[over] + 1, part[over] >> (np.uint64(64) - shift[over]))
        ones = (values >> np.uint64(bits)).astype(np.int64) + np.arange(n)
        size = (int(ones[-1]) if n else 0) + 2
        high = np.zeros((size // 64 + 1) * 8, np.uint8)
        np.bitwise_or.at(high, ones >> 3, (1 << (ones & 7)).astype(np.uint8))
        return cls(n, bits, low, high.view(np.uint64))

    def arrays(self) -> list[np.ndarray]:
        return [np.array([self.n, self.low_bits], np.uint64), self.low, self.high]

    def _select(self, cum: np.ndarray, k: np.ndarray, flip: int) -> np.ndarray:
        """Place of the k-th one (or zero, with ``flip``) of the high part."""
        word = np.searchsorted(cum, k, side="right") - 1
        rest = k - cum[word]
        octets = np.ascontiguousarray(self.high[word]).view(np.uint8).reshape(-1, 8) ^ flip
        before = np.cumsum(_ONES[octets], axis=1)
        byte = (before <= rest[:, None]).sum(axis=1)
        row = np.arange(len(k))
        rest = rest - np.where(byte > 0, before[row, byte - 1], 0)
        return word * 64 + byte * 8 + _PLACE[octets[row, byte], rest]

    def _low(self, i: np.ndarray) -> np.ndarray:
        if not self.low_bits:
            return np.zeros(len(i), np.uint64)
        at = i * self.low_bits
        word, shift = at >> 6, (at & 63).astype(np.uint64)
        rest = np.where(shift > 0, self.low[word + 1] << ((np.uint64(64) - shift) & np.uint64(63)),
                        np.uint64(0))
        return ((self.low[word] >> shift) | rest) & np.uint64((1 << self.low_bits) - 1)

    def get(self, i: np.ndarray) -> np.ndarray:
        high = (self._select(self._ones, i, 0) - i).astype(np.uint64)
        return (high << np.uint64(self.low_bits)) | self._low(i)

    def successor(self, x: np.ndarray) -> np.ndarray:
        """Index of the first number not below each x; n if there is none."""
        x = np.asarray(x, np.uint64)
        high = (x >> np.uint64(self.low_bits)).astype(np.int64)
        last = len(self.high) * 64 - self.n - 1  # zeros there are, less one
        start, stop = (np.where(h < 0, 0, self._select(
            self._zeros, np.clip(h, 0, last), 255) - np.clip(h, 0, last)) for h in (high - 1, high))
        stop = np.minimum(stop, self.n)
        start = np.where(high > last, self.n, np.minimum(start, self.n))
        stop = np.maximum(stop, start)
        low = x & np.uint64((1 << self.low_bits) - 1)
        open_ = np.flatnonzero(start < stop)
        while len(open_):
            mid = (start[open_] + stop[open_]) >> 1
            below = self._low(mid) < low[open_]
            start[open_[below]] = mid[below] + 1
            stop[open_[~below]] = mid[~below]
            open_ = open_[start[open_] < stop[open_]]
        return start
