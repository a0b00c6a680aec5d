"""Vectorised word scanning over Arrow text columns.

A word is a maximal run of bytes outside space and 0x09-0x0D. Words never cross documents.
Each word gets a 64-bit hash from a prefix polynomial, so cost is a few passes over the bytes,
with no Python object per word. Work proceeds in blocks cut at separators: memory beyond the
text itself is bounded by the block and eight bytes a word, however long a document is.
"""

from __future__ import annotations

import ctypes

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U = np.uint64
SEPARATOR = np.zeros(256, bool)
SEPARATOR[[0x20, *range(0x09, 0x0E)]] = True
BLOCK = 1 << 20
_BASE = U(0x9E3779B97F4A7C15 | 1)
_INVERSE = U(pow(int(_BASE), -1, 1 << 64))
_SECOND = U(0xA0761D6478BD642F)
_powers: dict[str, np.ndarray] = {}


def mix(h: np.ndarray) -> np.ndarray:
    """The 64-bit finaliser of splitmix64."""
    h = h ^ (h >> U(30))
    h *= U(0xBF58476D1CE4E5B9)
    h ^= h >> U(27)
    h *= U(0x94D049BB133111EB)
    h ^= h >> U(31)
    return h


_RAW = mix(np.arange(1, 257, dtype=U) * U(0x632BE59BD9B4E019))
_LOWER = _RAW.copy()
_LOWER[65:91] = _RAW[97:123]


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers.get("p", ())) < n:
        for k, b in (("p", _BASE), ("i", _INVERSE)):
            a = np.full(n, b, U)
            a[0] = 1
            _powers[k] = np.cumprod(a)
    return _powers["p"], _powers["i"]


def trim() -> None:
    """Give memory that is free now back to the system: a worker lives on for other tasks and stages."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):  # not glibc
        pass


def text_buffers(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and n+1 offsets of a string column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
        if isinstance(column, pa.ChunkedArray):
            column = column.chunk(0) if column.num_chunks else pa.array([], pa.large_string())
    column = column.cast(pa.large_string()).fill_null("")
    _, off, data = column.buffers()
    offsets = np.frombuffer(off, np.int64, len(column) + 1, column.offset * 8) if off else np.zeros(1, np.int64)
    raw = np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


class Words:
    """Starts, ends (byte positions), hashes and the first word index of each document."""

    __slots__ = ("data", "starts", "ends", "hashes", "first")

    def __init__(self, data: np.ndarray, offsets: np.ndarray, lower: bool = False, hashed: bool = True, prefixes: tuple[int, ...] = ()):
        starts, ends, hashes = [], [], []
        n, at = len(data), 0
        table = _LOWER if lower else _RAW
        while at < n:
            stop = min(n, at + BLOCK)
            while stop < n and not SEPARATOR[data[stop - 1]]:
                gap = np.flatnonzero(SEPARATOR[data[stop : stop + BLOCK]])
                stop = min(n, stop + (int(gap[0]) + 1 if len(gap) else BLOCK))
            part = data[at:stop]
            word = ~SEPARATOR[part]
            edge = offsets[np.searchsorted(offsets, at) : np.searchsorted(offsets, stop)] - at
            before = np.zeros(len(part), bool)
            before[1:] = word[:-1]
            before[edge] = False
            after = np.zeros(len(part), bool)
            after[:-1] = word[1:]
            after[edge[edge > 0] - 1] = False
            s, e = np.flatnonzero(word & ~before), np.flatnonzero(word & ~after) + 1
            starts.append(s + at)
            ends.append(e + at)
            if hashed:
                power, inverse = _power(max(BLOCK + 4096, len(part)))
                total = np.zeros(len(part) + 1, U)
                np.cumsum(table[part] * power[: len(part)], out=total[1:])
                hashes.append(mix((total[e] - total[s]) * inverse[s] + (e - s).astype(U)))
                for k in prefixes:
                    cut = np.minimum(e, s + k)
                    hashes.append(mix((total[cut] - total[s]) * inverse[s] + U(k << 32)))
            at = stop
        join = lambda x, kind: np.concatenate(x) if x else np.zeros(0, kind)
        self.data, self.starts, self.ends = data, join(starts, np.int64), join(ends, np.int64)
        k = 1 + len(prefixes)
        self.hashes = [join(hashes[i::k], U) for i in range(k)] if prefixes else join(hashes, U)  # a list with prefixes
        self.first = np.searchsorted(self.starts, offsets)

    @classmethod
    def of(cls, column, **how) -> "Words":
        return cls(*text_buffers(column), **how)

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def document(self) -> np.ndarray:
        """The document index of each word."""
        return np.repeat(np.arange(len(self.first) - 1, dtype=np.int32), self.counts)


def slices(column: pa.Array, size: int = 4 << 20):
    """(first row, rows) of runs of whole rows of about size bytes, so that arrays over words stay small."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < len(column):
        stop = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + size, side="right")))
        yield at, column.slice(at, stop - at)
        at = stop


class Rolling:
    """Hashes of windows of any length over words, by prefix sums. second: by another, independent hash of each word."""

    def __init__(self, hashes: np.ndarray, second: bool = False):
        hashes = mix(hashes ^ _SECOND) if second else hashes
        power, self.inverse = _power(len(hashes))
        self.total = np.zeros(len(hashes) + 1, U)
        np.cumsum(hashes * power[: len(hashes)], out=self.total[1:])

    def at(self, start: np.ndarray, n: int) -> np.ndarray:
        return mix((self.total[start + n] - self.total[start]) * self.inverse[start] ^ U(n))


def starts(first: np.ndarray, n: int) -> np.ndarray:
    """The first words of all windows of n words inside one document."""
    count = int(first[-1]) if len(first) else 0
    if count < n:
        return np.zeros(0, np.int64)
    inside = np.ones(count - n + 1, bool)
    ends = first[1:]
    for back in range(1, n):
        at = ends - back
        at = at[(at >= 0) & (at < len(inside))]
        inside[at] = False
    # a short document clears starts of its predecessor only where those cross its end, too
    return np.flatnonzero(inside)


def windows(hashes: np.ndarray, first: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all windows of n words inside one document, and the index of their first word."""
    at = starts(first, n)
    return (Rolling(hashes).at(at, n) if len(at) else np.zeros(0, U)), at


def coded(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct keys, and the index among them of each. A sort and its order are far faster here than a table of keys."""
    order = np.argsort(keys)
    ks = keys[order]
    new = np.concatenate([[True], ks[1:] != ks[:-1]]) if len(ks) else np.zeros(0, bool)
    code = np.empty(len(ks), np.int64)
    code[order] = np.cumsum(new) - 1
    return ks[new], code
