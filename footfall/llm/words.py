"""Words of Arrow text columns as 64-bit hashes, in numpy.

A word is a run of bytes other than the six ASCII white-space characters, with A-Z
lower-cased. Texts are taken in blocks of a megabyte, so memory follows the block and
the longest text, not the batch.

A word's hash is a polynomial modulo 2^64. Long words can be built for which all such
polynomials agree (alternating as in the Thue-Morse word), so words of more than ``LONG``
bytes are hashed by BLAKE2 instead.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

BLOCK = 1 << 20
LONG = 64

_WHITE = b"\x20\x09\x0a\x0b\x0c\x0d"
_SPACE = np.zeros(256, bool)
_SPACE[list(_WHITE)] = True
_VALUES = np.random.RandomState(11).randint(1, 1 << 62, 256).astype(np.uint64) * np.uint64(2) + np.uint64(1)
_VALUES[65:91] = _VALUES[97:123]  # A-Z as a-z
_VALUES[_SPACE] = 0
_BASE = 0x9E3779B97F4A7C15


def mixed(values: np.ndarray, seed: int = 0) -> np.ndarray:
    """Spread 64-bit values, one to one."""
    x = values ^ np.uint64(seed)
    x = x ^ (x >> np.uint64(31))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(32)
    return x


def _powers(n: int) -> np.ndarray:
    factors = np.full(n, _BASE, np.uint64)
    factors[0] = 1
    return np.cumprod(factors)


def _hashes(data: np.ndarray, fresh: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and hashes of the words of ``data``; no word goes over a place in ``fresh``."""
    solid = ~_SPACE[data]
    first = solid.copy()
    first[1:] &= ~solid[:-1]
    first[fresh] = solid[fresh]
    starts = np.flatnonzero(first)
    if not len(starts):
        return starts, np.zeros(0, np.uint64)
    inside = np.cumsum(first, dtype=np.int32) - 1
    at = np.arange(len(data), dtype=np.int64) - starts[np.maximum(inside, 0)]
    spans = np.diff(np.append(starts, len(data)))
    powers = _powers(int(spans.max()) + int(starts[0]) + 1)
    terms = _VALUES[data] * powers[np.maximum(at, 0)]
    hashes = mixed(np.add.reduceat(terms, starts))
    for k in np.flatnonzero(spans > LONG):  # the white space that follows a word is in its span
        word = data[starts[k] : starts[k] + spans[k]].tobytes().rstrip(_WHITE)
        if len(word) > LONG:
            hashes[k] = int.from_bytes(hashlib.blake2b(word.lower(), digest_size=8).digest(), "little")
    return starts, hashes


def _long_text(data: np.ndarray) -> np.ndarray:
    """The word hashes of one text of any length, cut at white space where it is long."""
    parts, at = [], 0
    while at < len(data):
        end = min(len(data), at + BLOCK)
        if end < len(data):
            spaces = np.flatnonzero(_SPACE[data[at:end]])
            if len(spaces):
                end = at + int(spaces[-1]) + 1
            else:
                later = np.flatnonzero(_SPACE[data[end:]])
                end = end + int(later[0]) + 1 if len(later) else len(data)
        parts.append(_hashes(data[at:end], np.zeros(1, np.int64))[1])
        at = end
    return np.concatenate(parts) if parts else np.zeros(0, np.uint64)


def word_blocks(texts: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """``(row, words, bounds)``: words of the rows from ``row`` on; those of the i-th are ``words[bounds[i]:bounds[i + 1]]``.

    Null counts as empty.
    """
    texts = texts.cast(pa.large_binary()).fill_null(b"")
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
    row = 0
    while row < len(texts):
        end = max(row + 1, int(np.searchsorted(offsets, offsets[row] + BLOCK, "right")) - 1)
        block = data[offsets[row] : offsets[end]]
        edges = offsets[row : end + 1] - offsets[row]
        if end == row + 1:
            words = _long_text(block)
            yield row, words, np.array([0, len(words)])
        else:
            full = edges[:-1][edges[1:] > edges[:-1]]
            starts, words = _hashes(block, full) if len(block) else (np.zeros(0, np.int64), np.zeros(0, np.uint64))
            yield row, words, np.searchsorted(starts, edges)
        row = end


def shingles(words: np.ndarray, n: int = 5) -> np.ndarray:
    """Hashes of all runs of ``n`` words; of fewer words, one hash of the whole run."""
    size = min(n, len(words))
    if not size:
        return words
    count = len(words) - size + 1
    total = np.full(count, size, np.uint64)
    for k in range(size):
        total = total * np.uint64(_BASE) + words[k : k + count]
    return mixed(total)
