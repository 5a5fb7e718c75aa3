"""Vectorised words, hashes and word windows over Arrow string columns.

Everything here works on the UTF-8 bytes of a slice of rows (``slices`` bounds
a slice by bytes, so memory does not follow the batch size). Separators are
ASCII, and no UTF-8 continuation byte is ASCII, so bytes can be classified one
by one. Null texts count as empty.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

U64 = np.uint64
SLICE_BYTES = 1 << 20

_BASE = U64(0x9E3779B97F4A7C15 | 1)
_BASE_INV = U64(pow(int(_BASE), -1, 1 << 64))


def mix64(x: np.ndarray) -> np.ndarray:
    """Bijective finaliser on unsigned 64-bit integers (wraps around)."""
    x = np.asarray(x, dtype=U64)
    with np.errstate(over="ignore"):
        x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


#: One random 64-bit value per byte, derived from a rule.
BYTE_VALUE = mix64(np.arange(1, 257, dtype=U64) * U64(0xD1342543DE82EF95))

SPACES = np.zeros(256, bool)
SPACES[[9, 10, 11, 12, 13, 32]] = True
#: Bytes of words ``[^\x20\x09-\x0D]+``.
WORD_BYTE = ~SPACES
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
IDENTITY = np.arange(256, dtype=np.uint8)

def worker_state() -> dict:
    """A dictionary that lives as long as this Python process. Functions travel
    to workers by value, so module globals would start anew with each task."""
    import sys
    import types
    return vars(sys.modules.setdefault("_lakecraft_worker", types.ModuleType("_lakecraft_worker")))


def powers(base: U64, n: int) -> np.ndarray:
    """base^0 .. base^(n-1) modulo 2^64, cached up to a few million entries."""
    key = int(base)
    cache = worker_state()
    p = cache.get(f"powers {key}")
    if p is None or len(p) < n:
        size = 1 << max(12, (max(n, 1) - 1).bit_length())
        p = np.ones(size, dtype=U64)
        have = 1
        while have < size:
            step = U64(pow(key, have, 1 << 64))
            p[have:2 * have] = p[:have] * step
            have *= 2
        if size <= 1 << 23:
            cache[f"powers {key}"] = p
    return p[:n]


def column_bytes(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets (n + 1) of a string or binary column without copying."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    n = len(col)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    wide = pa.types.is_large_string(col.type) or pa.types.is_large_binary(col.type)
    _, off, data = col.buffers()
    offsets = np.frombuffer(off, np.int64 if wide else np.int32)[col.offset:col.offset + n + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[offsets[0]:offsets[-1]], offsets - offsets[0]


def slices(offsets: np.ndarray, limit: int = SLICE_BYTES):
    """Row ranges [i, j) whose texts hold about ``limit`` bytes at most (one longer text stands alone)."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = int(np.searchsorted(offsets, offsets[i] + limit, side="right")) - 1
        j = min(max(j, i + 1), n)
        yield i, j
        i = j


class Words:
    """Words of some rows: byte ranges [start, end), row of each word, 64-bit word hashes."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, word_byte=WORD_BYTE, fold=IDENTITY):
        self.offsets = offsets
        n = len(data)
        self.data = data if fold is IDENTITY else fold[data]
        inside = word_byte[data]
        self.inside = inside
        before = np.zeros(n, bool)
        before[1:] = inside[:-1]
        first = offsets[:-1]
        first = first[first < n]
        before[first] = False
        after = np.zeros(n, bool)
        after[:-1] = inside[1:]
        last = offsets[1:]
        last = last[last > 0] - 1
        after[last] = False
        self.start = np.flatnonzero(inside & ~before)
        self.end = np.flatnonzero(inside & ~after) + 1
        self.row = np.searchsorted(offsets, self.start, side="right") - 1
        self._hash = None

    @property
    def n_rows(self) -> int:
        return len(self.offsets) - 1

    def counts(self) -> np.ndarray:
        return np.bincount(self.row, minlength=self.n_rows)

    def first(self) -> np.ndarray:
        """Index of each row's first word (n_rows + 1 entries)."""
        return np.concatenate([[0], np.cumsum(self.counts())])

    def _prefix(self) -> np.ndarray:
        n = len(self.data)
        c = np.zeros(n + 1, U64)
        np.cumsum(BYTE_VALUE[self.data] * powers(_BASE, n), out=c[1:])
        return c

    def spans_hash(self, start: np.ndarray, end: np.ndarray, prefix: np.ndarray | None = None) -> np.ndarray:
        c = self._prefix() if prefix is None else prefix
        inv = powers(_BASE_INV, len(self.data) + 1)
        return mix64((c[end] - c[start]) * inv[start] + (end - start).astype(U64))

    @property
    def hash(self) -> np.ndarray:
        if self._hash is None:
            self._hash = self.spans_hash(self.start, self.end)
        return self._hash

    def joined(self, keep: np.ndarray | None = None) -> tuple[bytes, np.ndarray, np.ndarray]:
        """The (kept) words, one space after each, as one bytes object; each
        kept word's start in it, and its length."""
        start, end = (self.start, self.end) if keep is None else (self.start[keep], self.end[keep])
        lens = end - start
        to = np.cumsum(lens + 1) - (lens + 1)
        out = np.full(int((lens + 1).sum()), 32, np.uint8)
        if keep is None:
            src = np.flatnonzero(self.inside)
        else:
            src = np.arange(int(lens.sum())) + np.repeat(start - (np.cumsum(lens) - lens), lens)
        out[src + np.repeat(to - start, lens)] = self.data[src]
        return out.tobytes(), to, lens


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each run of ``width`` values (len(x) - width + 1 results)."""
    if len(x) < width:
        return x[:0]
    a, p = x, 1
    while 2 * p <= width:
        a = np.minimum(a[:-p], a[p:])
        p *= 2
    rest = width - p
    return np.minimum(a[:len(a) - rest], a[rest:]) if rest else a


def window_hash(values: np.ndarray, width: int, base: int) -> np.ndarray:
    """Hash of each run of ``width`` 64-bit values."""
    n = len(values) - width + 1
    if n <= 0:
        return np.zeros(0, U64)
    b = U64(base | 1)
    c = np.zeros(len(values) + 1, U64)
    np.cumsum(values * powers(b, len(values)), out=c[1:])
    inv = powers(U64(pow(int(b), -1, 1 << 64)), n)
    return mix64((c[width:] - c[:-width]) * inv)
