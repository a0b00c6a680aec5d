"""Counting quotient filters as immutable, mergeable blocks.

A fingerprint of p bits splits into a quotient (high bits) and a remainder (low bits). Quotients
of the sorted fingerprints are kept in unary (one bit an entry plus one a quotient), remainders
in byte planes, counts above one apart. Because all filters split the same hash space, merging is
lossless: the sorted remainders of each quotient are interleaved and the counts of equal ones
added. The whole space is dealt into 2**bits buckets, so filters of many partitions meet bucket
by bucket in as many tasks.
"""

from __future__ import annotations

import struct

import numpy as np

U = np.uint64


def bucket_bits(partitions: int) -> int:
    return max(0, (partitions - 1).bit_length())


def pack_keys(keys: np.ndarray, width: int) -> bytes:
    """Sorted keys below 2**width: quotients in unary, remainders in byte planes."""
    n = len(keys)
    if not n:
        return struct.pack("<IBB", 0, width, 0)
    best = min(range(0, width + 8, 8), key=lambda r: r + min(2.0 ** max(0, width - r) / n, 1e9))
    rem = min(best, width)
    planes = (rem + 7) // 8
    high = (keys >> U(rem)).astype(np.int64) if rem < 64 else np.zeros(n, np.int64)
    bits = np.zeros(int(high[-1]) + n, np.uint8)
    bits[high + np.arange(n)] = 1
    low = np.ascontiguousarray(keys).view(np.uint8).reshape(n, 8)[:, :planes]
    if rem % 8:
        low = low.copy()
        low[:, -1] &= (1 << (rem % 8)) - 1
    return struct.pack("<IBB", n, width, rem) + struct.pack("<I", len(bits)) + np.packbits(bits).tobytes() + np.ascontiguousarray(low.T).tobytes()


def unpack_keys(body: bytes, at: int = 0) -> tuple[np.ndarray, int]:
    n, _, rem = struct.unpack_from("<IBB", body, at)
    at += 6
    if not n:
        return np.zeros(0, U), at
    (m,) = struct.unpack_from("<I", body, at)
    at += 4
    size = (m + 7) // 8
    bits = np.unpackbits(np.frombuffer(body, np.uint8, size, at), count=m)
    high = np.flatnonzero(bits) - np.arange(n)
    at += size
    planes = (rem + 7) // 8
    low = np.zeros((n, 8), np.uint8)
    low[:, :planes] = np.frombuffer(body, np.uint8, n * planes, at).reshape(planes, n).T
    keys = low.view(U).ravel()
    if rem < 64:
        keys = keys | (high.astype(U) << U(rem))
    return keys, at + n * planes


def pack_counts(counts: np.ndarray) -> bytes:
    """Counts of at least zero; nearly all are one, so only others are written."""
    n = len(counts)
    other = np.flatnonzero(counts != 1)
    if len(other) * 12 < n:
        return b"s" + struct.pack("<I", len(other)) + other.astype("<u4").tobytes() + counts[other].astype("<u8").tobytes()
    wide = 1 if not n or counts.max() < 256 else 2 if counts.max() < 65536 else 4 if counts.max() < 1 << 32 else 8
    return b"d" + struct.pack("<IB", n, wide) + counts.astype(f"<u{wide}").tobytes()


def unpack_counts(body: bytes, n: int, at: int = 0) -> tuple[np.ndarray, int]:
    if body[at : at + 1] == b"s":
        (m,) = struct.unpack_from("<I", body, at + 1)
        at += 5
        out = np.ones(n, np.int64)
        out[np.frombuffer(body, "<u4", m, at)] = np.frombuffer(body, "<u8", m, at + 4 * m)
        return out, at + 12 * m
    m, wide = struct.unpack_from("<IB", body, at + 1)
    return np.frombuffer(body, f"<u{wide}", m, at + 6).astype(np.int64), at + 6 + wide * m


class CountingQuotientFilter:
    """Sorted distinct fingerprints below 2**width, and the count of each."""

    __slots__ = ("width", "keys", "counts")

    def __init__(self, keys: np.ndarray, counts: np.ndarray, width: int):
        self.keys, self.counts, self.width = keys, counts, width

    @classmethod
    def build(cls, fingerprints: np.ndarray, width: int, weights: np.ndarray | None = None) -> "CountingQuotientFilter":
        if not len(fingerprints):
            return cls(np.zeros(0, U), np.zeros(0, np.int64), width)
        if weights is None:
            keys = np.sort(fingerprints)
            start = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
            return cls(keys[start], np.diff(np.append(start, len(keys))), width)
        order = np.argsort(fingerprints, kind="stable")
        keys = fingerprints[order]
        start = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
        return cls(keys[start], np.add.reduceat(weights[order], start), width)

    @classmethod
    def merge(cls, filters: list["CountingQuotientFilter"]) -> "CountingQuotientFilter":
        width = filters[0].width if filters else 64
        return cls.build(np.concatenate([f.keys for f in filters]), width, np.concatenate([f.counts for f in filters])) if filters else cls.build(np.zeros(0, U), width)

    @staticmethod
    def totals(filters: list["CountingQuotientFilter"]) -> list[np.ndarray]:
        """For each filter, the count that each of its keys has in the merged one."""
        keys = np.concatenate([f.keys for f in filters])
        if not len(keys):
            return [f.counts for f in filters]
        order = np.argsort(keys, kind="stable")
        ks = keys[order]
        start = np.flatnonzero(np.concatenate([[True], ks[1:] != ks[:-1]]))
        sums = np.add.reduceat(np.concatenate([f.counts for f in filters])[order], start)
        out = np.empty(len(keys), np.int64)
        out[order] = np.repeat(sums, np.diff(np.append(start, len(ks))))
        return np.split(out, np.cumsum([len(f.keys) for f in filters])[:-1])

    def split(self, bits: int) -> list["CountingQuotientFilter"]:
        """One filter for each of 2**bits ranges of quotients, keys relative to the range."""
        width = self.width - bits
        edges = np.searchsorted(self.keys, np.arange(1, 1 << bits, dtype=U) << U(width))
        mask = U((1 << width) - 1)
        return [CountingQuotientFilter(k & mask, c, width) for k, c in zip(np.split(self.keys, edges), np.split(self.counts, edges), strict=True)]

    def to_bytes(self) -> bytes:
        return pack_keys(self.keys, self.width) + pack_counts(self.counts)

    @classmethod
    def from_bytes(cls, body: bytes) -> "CountingQuotientFilter":
        keys, at = unpack_keys(body)
        counts, _ = unpack_counts(body, len(keys), at)
        return cls(keys, counts, body[4])
