"""Vectorised word kernels over Arrow string batches (words are runs of bytes
other than 0x20 and 0x09-0x0D, the same for any UTF-8 text).

Word and window identities are 64-bit hashes: polynomial prefix sums over
byte values, then a finalising mix. Where a result must not rest on hashes the
operators compare the words themselves.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SPACES = b"\x20\x09\x0a\x0b\x0c\x0d"
SPACE_TEXT = SPACES.decode()

IS_WORD = np.ones(256, bool)
IS_WORD[list(SPACES)] = False
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_U = np.uint64
_MUL_BYTE = 0x9E3779B97F4A7C15
_MUL_WORD = 0xD6E8FEB86659FD93
BYTE_VALUE = np.random.RandomState(20240229).randint(1, 2**62, 256).astype(_U) * _U(2) + _U(1)


def mix(h: np.ndarray) -> np.ndarray:
    """Finalising mix of 64-bit values (a bijection)."""
    h = h ^ (h >> _U(32))
    h = h * _U(0xBF58476D1CE4E5B9)
    h = h ^ (h >> _U(29))
    h = h * _U(0x94D049BB133111EB)
    return h ^ (h >> _U(32))


@functools.lru_cache(maxsize=8)
def _powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    inverse = pow(base, -1, 1 << 64)
    out = []
    for b in (base, inverse):
        p = np.full(n, b, _U)
        p[0] = 1
        out.append(np.cumprod(p, dtype=_U))
    return out[0], out[1]


def powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    size = 1 << max(16, int(n).bit_length())
    p, q = _powers(base, size)
    return p, q


def prefix(values: np.ndarray, base: int) -> tuple[np.ndarray, np.ndarray]:
    """Prefix sums of values * base^i and the inverse powers."""
    p, q = powers(base, len(values) + 1)
    c = np.zeros(len(values) + 1, _U)
    np.cumsum(values * p[: len(values)], dtype=_U, out=c[1:])
    return c, q


class Words:
    """Words of a batch of texts: byte starts and ends, offsets per text."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        self.data, self.offsets = data, offsets
        n = len(data)
        w = IS_WORD[data]
        left = np.empty(n + 1, bool)  # left[i]: byte i-1 is of the same word run
        left[0] = False
        left[1:] = w
        left[offsets] = False
        right = np.empty(n + 1, bool)
        right[:n] = w
        right[n] = False
        right[offsets] = False
        self.starts = np.flatnonzero(w & ~left[:n])
        self.ends = np.flatnonzero(w & ~right[1:]) + 1
        self.docs = np.searchsorted(self.starts, offsets)  # word offsets per text

    def hashes(self, lower: bool, step: int = 1 << 18) -> np.ndarray:
        """Hash of each word, over about ``step`` bytes at once."""
        out = np.empty(len(self.starts), _U)
        at = 0
        while at < len(out):
            lo = self.starts[at]
            end = max(at + 1, int(np.searchsorted(self.starts, lo + step)))
            d = self.data[lo: self.ends[end - 1]]
            c, q = prefix(BYTE_VALUE[LOWER[d] if lower else d], _MUL_BYTE)
            s, e = self.starts[at:end] - lo, self.ends[at:end] - lo
            out[at:end] = mix((c[e] - c[s]) * q[s] + (e - s).astype(_U))
            at = end
        return out

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.docs)


def windows(h: np.ndarray, doc_offsets: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all windows of k consecutive words inside one text, and the
    index of each window's first word."""
    n = len(h)
    if n < k:
        return np.zeros(0, _U), np.zeros(0, np.int64)
    c, q = prefix(h, _MUL_WORD)
    g = (c[k:] - c[: n - k + 1]) * q[: n - k + 1]
    room = np.repeat(doc_offsets[1:], np.diff(doc_offsets)) - np.arange(n)
    first = np.flatnonzero(room >= k)
    return mix(g[first]), first


def span_hash(h: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """Hash of the word sequences [lo, hi), different for different lengths."""
    c, q = prefix(h, _MUL_WORD)
    return mix(mix((c[hi] - c[lo]) * q[lo]) + (hi - lo).astype(_U))


def slices(col: pa.Array, most: int = 1 << 20) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Row ranges of a string column with about ``most`` bytes each (one row at
    least): (first row, end row, bytes, offsets from 0)."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if col.null_count:
        col = col.fill_null("")
    kind = np.int64 if pa.types.is_large_string(col.type) or pa.types.is_large_binary(col.type) else np.int32
    buffers = col.buffers()
    if len(col) == 0:
        return
    offsets = np.frombuffer(buffers[1], kind)[col.offset: col.offset + len(col) + 1].astype(np.int64)
    data = np.frombuffer(buffers[2], np.uint8) if buffers[2] is not None else np.zeros(0, np.uint8)
    at = 0
    while at < len(col):
        end = int(np.searchsorted(offsets, offsets[at] + most, side="right")) - 1
        end = min(len(col), max(at + 1, end))
        yield at, end, data[offsets[at]: offsets[end]], offsets[at: end + 1] - offsets[at]
        at = end
