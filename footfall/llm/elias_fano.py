"""Elias-Fano coding of sorted numbers in numpy, read in place.

Of each number the low bytes are kept as they are; the high parts are a bit vector in unary:
a one per number, a zero per step of the high part. About 2 bits and the low bytes each.
"""

from __future__ import annotations

import struct

import numpy as np

_SELECT = np.array([[([i for i in range(8) if b >> i & 1] + [0] * 8)[k] for k in range(8)] for b in range(256)], np.uint8)
#: Values searched at a time, so the work stays in the processor's cache.
_CHUNK = 1 << 15
_HEAD = struct.Struct("<QQB7x")


class EliasFano:
    """A view of encoded bytes; ``data`` may be any buffer, such as a memory map."""

    def __init__(self, data, offset: int = 0):
        self.size, words, self.low_bytes = _HEAD.unpack_from(data, offset)
        offset += _HEAD.size
        self.words = np.frombuffer(data, np.uint64, words, offset)
        offset += 8 * words
        self.lows = np.frombuffer(data, np.uint8, self.size * self.low_bytes, offset).reshape(self.size, self.low_bytes)
        self.end = offset + -(-self.lows.size // 8) * 8
        self._zeros = None

    @staticmethod
    def encode(values: np.ndarray, universe: int | None = None) -> bytes:
        """``values`` are sorted, of type uint64; equal ones may stand beside each other."""
        n = len(values)
        top = int(values[-1]) if n else 0
        universe = max(top + 1, universe or 0)
        low_bytes = min(7, -(-max(0, (universe // max(n, 1)).bit_length() - 1) // 8))
        highs = (values >> np.uint64(8 * low_bytes)).astype(np.int64)
        last = (universe >> 8 * low_bytes) + 2
        bits = np.zeros(-(-(n + last) // 64) * 64, np.uint8)
        bits[highs + np.arange(n)] = 1
        lows = np.ascontiguousarray(values).view(np.uint8).reshape(n, 8)[:, :low_bytes]
        words = np.packbits(bits, bitorder="little").tobytes()
        body = lows.tobytes()
        return _HEAD.pack(n, len(words) // 8, low_bytes) + words + body + b"\0" * (-len(body) % 8)

    def low(self, places: np.ndarray) -> np.ndarray:
        out = np.zeros((len(places), 8), np.uint8)
        out[:, : self.low_bytes] = self.lows[places]
        return out.view(np.uint64).ravel()

    def decode(self) -> np.ndarray:
        """All numbers."""
        ones = np.flatnonzero(np.unpackbits(self.words.view(np.uint8), bitorder="little"))[: self.size]
        return ((ones - np.arange(self.size)).astype(np.uint64) << np.uint64(8 * self.low_bytes)) | self.low(np.arange(self.size))

    def _select_in(self, words: np.ndarray, nth: np.ndarray) -> np.ndarray:
        """Place of the nth one inside each word."""
        parts = words.view(np.uint8).reshape(-1, 8)
        upto = np.cumsum(np.bitwise_count(parts), axis=1, dtype=np.int64)
        part = (upto <= nth[:, None]).sum(axis=1)
        rows = np.arange(len(words))
        before = np.where(part > 0, upto[rows, part - 1], 0)
        return 8 * part + _SELECT[parts[rows, part], nth - before]

    def _below(self, highs: np.ndarray) -> np.ndarray:
        """How many numbers have a high part below each of ``highs``."""
        if self._zeros is None:
            self._zeros = np.cumsum(64 - np.bitwise_count(self.words).astype(np.int64))
        nth = np.maximum(highs.astype(np.int64) - 1, 0)
        word = np.searchsorted(self._zeros, nth, "right")
        inside = nth - np.where(word > 0, self._zeros[word - 1], 0)
        place = 64 * word + self._select_in(np.ascontiguousarray(~self.words[word]), inside)
        return np.where(highs > 0, place - nth, 0)

    def access(self, places: np.ndarray) -> np.ndarray:
        """The numbers at ``places``."""
        ones = np.cumsum(np.bitwise_count(self.words).astype(np.int64))
        word = np.searchsorted(ones, places, "right")
        inside = places - np.where(word > 0, ones[word - 1], 0)
        at = 64 * word + self._select_in(np.ascontiguousarray(self.words[word]), inside)
        return ((at - places).astype(np.uint64) << np.uint64(8 * self.low_bytes)) | self.low(places)

    def find(self, values: np.ndarray, first: np.ndarray | None = None, end: np.ndarray | None = None) -> np.ndarray:
        """The place of each value inside its range ``first:end`` (or anywhere), -1 where it is not."""
        if not self.size or not len(values):
            return np.full(len(values), -1)
        part = lambda x, at: None if x is None else x[at : at + _CHUNK]
        return np.concatenate(
            [self._find(part(values, i), part(first, i), part(end, i)) for i in range(0, len(values), _CHUNK)]
        )

    def _find(self, values: np.ndarray, first: np.ndarray | None, end: np.ndarray | None) -> np.ndarray:
        shift = np.uint64(8 * self.low_bytes)
        highs, wanted = values >> shift, values & ((np.uint64(1) << shift) - np.uint64(1))
        most = np.uint64(len(self.words) * 64 - self.size - 1)
        outside = highs >= most
        highs = np.minimum(highs, most - np.uint64(1))
        low, high = self._below(highs), self._below(highs + np.uint64(1))
        if first is not None:
            low, high = np.maximum(low, first), np.minimum(high, end)
        stop = high.copy()
        open_ = np.flatnonzero(low < high)
        while len(open_):
            middle = (low[open_] + high[open_]) // 2
            less = self.low(middle) < wanted[open_]
            low[open_[less]] = middle[less] + 1
            high[open_[~less]] = middle[~less]
            open_ = open_[low[open_] < high[open_]]
        at = np.minimum(low, self.size - 1)
        return np.where((low < stop) & (self.low(at) == wanted) & ~outside, low, -1)
