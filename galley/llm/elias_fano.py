"""Elias-Fano sequences and a two-level n-gram trie over them, in one memory-mapped file.

A monotone sequence keeps the low bits of each value as they are, and the high bits in unary.
``successor`` finds the first value of at least x: select0 gives the run of values that share
x's high bits, and the low bits decide. All calls are vectorised.
"""

from __future__ import annotations

import os
import struct
import tempfile

import numpy as np

U = np.uint64
_POP = np.array([bin(i).count("1") for i in range(256)], np.uint8)
_SELECT = np.array([[*[j for j in range(8) if i >> j & 1], *[8] * 8][:8] for i in range(256)], np.uint8)


def _align(parts: list[bytes], body: bytes) -> None:
    parts.append(body + b"\0" * (-len(body) % 8))


class Bits:
    """A bit vector with counts of ones before each 64 bits, over a buffer."""

    @staticmethod
    def pack(ones: np.ndarray, size: int) -> bytes:
        bits = np.zeros(-(-size // 64) * 64, np.uint8)
        bits[ones] = 1
        raw = np.packbits(bits, bitorder="little")
        before = np.concatenate([[0], np.cumsum(_POP[raw].reshape(-1, 8).sum(1))]).astype("<u4")
        out: list[bytes] = []
        _align(out, struct.pack("<Q", len(raw)))
        _align(out, raw.tobytes())
        _align(out, before.tobytes())
        return b"".join(out)

    def __init__(self, buffer: np.ndarray, at: int):
        n = int(buffer[at : at + 8].view("<u8")[0])
        self.raw = buffer[at + 8 : at + 8 + n]
        at += 8 + n
        words = n // 8 + 1
        self.before = buffer[at : at + 4 * words].view("<u4")
        self.end = at + -(-4 * words // 8) * 8
        self.zeros = np.arange(words, dtype=np.int64) * 64 - self.before

    def _select(self, k: np.ndarray, ones: bool) -> np.ndarray:
        table = self.before if ones else self.zeros
        word = np.searchsorted(table, k, side="right") - 1
        left = k - table[word].astype(np.int64)
        byte, out = word * 8, np.full(len(k), -1, np.int64)
        for _ in range(8):
            value = self.raw[np.minimum(byte, len(self.raw) - 1)]
            value = value if ones else ~value
            here = _POP[value]
            hit = (out < 0) & (left < here)
            out[hit] = byte[hit] * 8 + _SELECT[value[hit], left[hit]]
            left -= np.where(out < 0, here, 0)
            byte += 1
        return out

    def select1(self, k: np.ndarray) -> np.ndarray:
        return self._select(k, True)

    def select0(self, k: np.ndarray) -> np.ndarray:
        return self._select(k, False)


def _planes(low: int) -> list[str]:
    out, left = [], -(-low // 8)
    for size in (4, 2, 1):
        while left >= size:
            out.append(f"<u{size}")
            left -= size
    return out


class EliasFano:
    """A monotone sequence of values below ``universe`` (at most 2**63)."""

    @staticmethod
    def pack(values: np.ndarray, universe: int) -> bytes:
        n = len(values)
        low = max(0, (universe // max(1, n)).bit_length() - 1)
        high = (values >> U(low)).astype(np.int64)
        top = universe >> low
        out: list[bytes] = []
        _align(out, struct.pack("<QQQ", n, low, top))
        rest = values & U((1 << low) - 1)
        for kind in _planes(low):
            _align(out, rest.astype(kind).tobytes())
            rest = rest >> U(8 * np.dtype(kind).itemsize)
        out.append(Bits.pack(high + np.arange(n), n + top + 2))
        return b"".join(out)

    def __init__(self, buffer: np.ndarray, at: int = 0):
        self.n, self.low, self.top = (int(x) for x in buffer[at : at + 24].view("<u8"))
        at += 24
        self.planes = []
        for kind in _planes(self.low):
            size = self.n * np.dtype(kind).itemsize
            self.planes.append(buffer[at : at + size].view(kind))
            at += -(-size // 8) * 8
        self.bits = Bits(buffer, at)
        self.end = self.bits.end

    def _low(self, i: np.ndarray) -> np.ndarray:
        out, shift = np.zeros(len(i), U), 0
        for p in self.planes:
            out |= p[i].astype(U) << U(shift)
            shift += 8 * p.itemsize
        return out

    def get(self, i: np.ndarray) -> np.ndarray:
        return ((self.bits.select1(i) - i).astype(U) << U(self.low)) | self._low(i)

    def successor(self, x: np.ndarray, first: np.ndarray | None = None, end_: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """The index of the first value of at least x (n where there is none), and whether it is x. With first and end_ the search is
        among the values from first on and before end_ (their end where there is none)."""
        high = (x >> U(self.low)).astype(np.int64)
        begin = np.where(high > 0, self.bits.select0(np.maximum(high - 1, 0)) - high + 1, 0)
        end = self.bits.select0(high) - high
        if first is not None:
            begin, end = np.clip(begin, first, end_), np.clip(end, first, end_)
        low = x & U((1 << self.low) - 1)
        i, open_ = begin.copy(), np.flatnonzero(begin < end)
        equal = np.zeros(len(x), bool)
        while len(open_):
            value = self._low(i[open_])
            equal[open_] = value == low[open_]
            open_ = open_[value < low[open_]]
            i[open_] += 1
            open_ = open_[i[open_] < end[open_]]
        return i, equal


class BigramTrie:
    """Contexts (48-bit ids) -> pointers -> successors (40-bit ids, relative to their context) -> codes.

    Successors of the context with index i are kept as (i << 40) + id, so the whole level is one
    monotone sequence; a successor is searched only in the range that the pointers give for its context.
    Codes are one byte: see lm.quantise.
    """

    CONTEXT_BITS, ID_BITS = 48, 40

    @classmethod
    def pack(cls, context: np.ndarray, successor: np.ndarray, codes: np.ndarray) -> bytes:
        """From pairs sorted by context, then successor, without repeats."""
        start = np.flatnonzero(np.concatenate([[True], context[1:] != context[:-1]])) if len(context) else np.zeros(0, np.int64)
        index = np.repeat(np.arange(len(start), dtype=np.int64), np.diff(np.append(start, len(context))))
        parts = [
            EliasFano.pack(context[start], 1 << cls.CONTEXT_BITS),
            EliasFano.pack(np.append(start, len(context)).astype(U), len(context) + 1),
            EliasFano.pack((index.astype(U) << U(cls.ID_BITS)) + successor, max(1, len(start)) << cls.ID_BITS),
            codes.astype(np.uint8).tobytes(),
        ]
        return struct.pack("<QQ", len(start), len(context)) + b"".join(parts)

    def __init__(self, buffer: np.ndarray):
        self.contexts = EliasFano(buffer, 16)
        self.pointers = EliasFano(buffer, self.contexts.end)
        self.successors = EliasFano(buffer, self.pointers.end)
        self.codes = buffer[self.successors.end :]

    def lookup(self, context: np.ndarray, successor: np.ndarray) -> np.ndarray:
        """The code of each pair, 0 where it is unknown."""
        out = np.zeros(len(context), np.uint8)
        i, known = self.contexts.successor(context)
        at = np.flatnonzero(known)
        if not len(at):
            return out
        i = i[at]
        lo, hi = (self.pointers.get(i + k).astype(np.int64) for k in (0, 1))
        j, good = self.successors.successor((i.astype(U) << U(self.ID_BITS)) + successor[at], lo, hi)
        out[at[good]] = self.codes[j[good]]
        return out


class MappedTrie:
    """A trie written to a file of the task and memory-mapped; the file goes with the context."""

    def __init__(self, body: bytes):
        handle, self.path = tempfile.mkstemp(prefix="trie-")
        with os.fdopen(handle, "wb") as f:
            f.write(body)

    def __enter__(self) -> BigramTrie:
        return BigramTrie(np.memmap(self.path, np.uint8, "r"))

    def __exit__(self, *_) -> None:
        os.unlink(self.path)
