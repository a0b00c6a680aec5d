"""Substring dedup by level-wise doubling (operator 4).

The first length is ``min_words``. All its windows are sent as 48-bit fingerprints with counts; being a filter, its rare collisions only let a few
more windows through. Windows repeated at one length alone, one behind the other, make windows of twice that length (26, 52, 104, ...
for 13), until no candidates survive.

What goes is decided at the first length: each repeated window is sent with 128 bits (two independent hashes) and the smallest doc_id of its
chunk, and one bit comes back: whether a smaller doc_id has it. Longer windows remove no further words; they say how long a passage is
shared (``longest``). All their lengths go in one exchange: a window goes if all its parts of the first length are repeated, and counts
as repeated if it is itself, and so are both its halves (at most 1 in 200 of those sent isn't, so a pass for each length
would spare next to nothing). Beyond the first length 48-bit fingerprints tell windows apart.

Removal covers words, judged on the input. A null doc_id counts as larger than all others. Rows that repeat a doc_id never
remove each other's words (no doc_id among them is smaller), but count as different documents for ``longest``. Null and empty texts have no words; texts below
min_words lose none. A very long text is looked at whole, in one chunk. An empty table gives an empty result. Only the two named columns are read, so
others may have any name.
"""

from __future__ import annotations

import hashlib
import struct

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from galley.llm import chunks as C
from galley.llm.quotient import CountingQuotientFilter as CQF
from galley.llm.quotient import pack_keys, unpack_keys
from galley.llm.words import Rolling, Words, coded, starts

U = np.uint64
FILTER_BITS = 48
SCHEMA = "doc_id bigint, n_words bigint, n_removed bigint, n_spans bigint, longest bigint, kept_text string, kept_sha256 string"


def _in_documents(keys: np.ndarray, doc: np.ndarray, docs: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct keys (of FILTER_BITS), and in how many documents each is (two are enough to know)."""
    if docs <= 1 << (64 - FILTER_BITS):
        both = np.sort(keys << U(64 - FILTER_BITS) | doc.astype(U))
        ks, ds = both >> U(64 - FILTER_BITS), both & U((1 << (64 - FILTER_BITS)) - 1)
    else:
        order = np.lexsort((doc, keys))
        ks, ds = keys[order], doc[order]
    new = np.concatenate([[True], ks[1:] != ks[:-1]]) if len(ks) else np.zeros(0, bool)
    start = np.flatnonzero(new)
    many = np.logical_or.reduceat(np.concatenate([[False], (ds[1:] != ds[:-1]) & ~new[1:]]), start) if len(start) else np.zeros(0, bool)
    return ks[start], 1 + many.astype(np.int64)


def doubled(at: np.ndarray, doc: np.ndarray, size: int) -> list[tuple[int, np.ndarray]]:
    """(length, first words) of the windows of 2, 4, 8, ... times size words of one document whose parts of that size all start at one
    of ``at``, until there are none."""
    out, good = [], np.zeros(len(doc) + 1, bool)
    good[at] = True
    while True:
        at = at[at + size < len(doc)]
        at = at[good[at + size] & (doc[at] == doc[at + size])]
        if not len(at):
            return out
        size *= 2
        good[:] = False
        good[at] = True
        out.append((size, at))


def _runs(h: np.ndarray, h2: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The order by both hashes, and the places in it where a new pair of them begins."""
    order = np.argsort(h, kind="stable")
    a, b = h[order], h2[order]
    if ((a[1:] == a[:-1]) & (b[1:] != b[:-1])).any():
        order = np.lexsort((h2, h))
        a, b = h[order], h2[order]
    return order, np.flatnonzero(np.concatenate([[True], (a[1:] != a[:-1]) | (b[1:] != b[:-1])])) if len(h) else np.zeros(0, np.int64)


def _split(keys: np.ndarray, bits: int) -> np.ndarray:
    return np.searchsorted(keys, np.arange(1, 1 << bits, dtype=U) << U(64 - bits))


def substring_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = 13, with_text: bool = True) -> DataFrame:
    """One row a document: words in all, words and spans removed, longest (the longest of the doubled lengths at which a window of the
    document is in another one, too; 0 without any), the kept text (words joined by one space; null without with_text) and its SHA-256."""
    _, chunks, bits = C.layout(docs, text_col)
    stored = C.store(docs, id_col, text_col, chunks)
    size, shift, mask = min_words, U(64 - FILTER_BITS), U((1 << (64 - bits)) - 1)

    def longer(words: Words, rolling: Rolling, at: np.ndarray, doc: np.ndarray) -> tuple[list[tuple[int, np.ndarray]], np.ndarray]:
        """Candidates of all longer lengths, and their fingerprints, one length after the other."""
        found = doubled(at, doc, size)
        return found, np.concatenate([rolling.at(a, n) >> shift for n, a in found]) if found else np.zeros(0, U)

    def emit_filter(_, chunk: C.Chunk):
        words = Words(chunk.data, chunk.offsets)
        at = starts(words.first, size)
        keys, counts = _in_documents(Rolling(words.hashes).at(at, size) >> shift, words.document()[at], len(chunk.ids))
        for b, part in enumerate(CQF(keys, counts, FILTER_BITS).split(bits)):
            if len(part.keys):
                yield b, part.to_bytes()

    def merge_filter(bodies: list[bytes]) -> list[bytes]:
        return [C.pack_bits(x > 1) for x in CQF.totals([CQF.from_bytes(x) for x in bodies])]

    def emit_windows(k: int, chunk: C.Chunk, answers: dict[int, bytes]):
        words = Words(chunk.data, chunk.offsets)
        doc, rolling = words.document(), Rolling(words.hashes)
        at = starts(words.first, size)
        h = rolling.at(at, size)
        alive = C.read_bits(answers)[coded(h >> shift)[1]] if len(h) else np.zeros(0, bool)
        at, h = at[alive], h[alive]
        h2 = Rolling(words.hashes, second=True).at(at, size)
        order, new = _runs(h, h2)  # stable: the first of a run is of the smallest doc_id, as chunks are sorted
        first = order[new]
        keys, second, owner = h[first], h2[first], doc[at[first]]
        found, more = longer(words, rolling, at, doc)
        filters = CQF(*_in_documents(more, np.concatenate([doc[a] for _, a in found]) if found else np.zeros(0, np.int64), len(chunk.ids)), FILTER_BITS).split(bits)
        edges = _split(keys, bits)
        for b, (part, other, of) in enumerate(zip(*(np.split(x, edges) for x in (keys, second, owner)), strict=True)):
            if len(part) or len(filters[b].keys):
                docs_, code = np.unique(of, return_inverse=True)
                wide = 2 if len(docs_) < 65536 else 4
                own = (
                    struct.pack("<IIB", len(docs_), len(part), wide) + chunk.ids[docs_].tobytes() + chunk.nulls[docs_].tobytes()
                    + code.astype(f"<u{wide}").tobytes() + other.tobytes() + pack_keys(part & mask, 64 - bits)
                )
                yield b, struct.pack("<I", len(own)) + own + filters[b].to_bytes()
        yield C.note(k, C.pack_bits(alive))

    def merge_windows(bodies: list[bytes]) -> list[bytes]:
        parts, filters = [], []
        for x in bodies:
            (length,) = struct.unpack_from("<I", x)
            n, m, wide = struct.unpack_from("<IIB", x, 4)
            at = 13 + 9 * n
            code = np.frombuffer(x, f"<u{wide}", m, at)
            ids, null = np.frombuffer(x, np.int64, n, 13)[code], np.frombuffer(x, bool, n, 13 + 8 * n)[code]
            at += wide * m
            parts.append((unpack_keys(x, at + 8 * m)[0], np.frombuffer(x, U, m, at), ids, null))
            filters.append(CQF.from_bytes(x[4 + length :]))
        k, k2, ids, null = (np.concatenate(x) for x in zip(*parts, strict=True))
        smaller = np.zeros(len(k), bool)
        if len(k):
            order, new = _runs(k, k2)
            runs = np.diff(np.append(new, len(k)))
            least = np.minimum.reduceat(np.where(null, np.iinfo(np.int64).max, ids)[order], new)
            some = np.logical_or.reduceat(~null[order], new)
            smaller[order] = np.repeat(some, runs) & (null[order] | (np.repeat(least, runs) < ids[order]))
        owned = np.split(smaller, np.cumsum([len(x[0]) for x in parts])[:-1])
        return [C.pack_bits(a) + C.pack_bits(b > 1) for a, b in zip(owned, CQF.totals(filters), strict=True)]

    def last(chunk: C.Chunk, answers: dict[int, bytes]) -> pa.Table:
        words = Words(chunk.data, chunk.offsets)
        doc, rolling = words.document(), Rolling(words.hashes)
        at = starts(words.first, size)[C.unpack_bits(answers[-1])] if -1 in answers else np.zeros(0, np.int64)
        h, h2 = rolling.at(at, size), Rolling(words.hashes, second=True).at(at, size)
        owned, shared = [np.zeros(0, bool)], [np.zeros(0, bool)]
        for b in sorted(answers):
            if b >= 0:
                owned.append(C.unpack_bits(answers[b]))
                shared.append(C.unpack_bits(answers[b], 4 + (len(owned[-1]) + 7) // 8))
        gone = np.zeros(len(h), bool)
        if len(h):
            order, new = _runs(h, h2)
            runs = np.diff(np.append(new, len(h)))
            of, owner = doc[at[order]], np.repeat(doc[at[order[new]]], runs)
            here = ~chunk.nulls[owner] & (chunk.nulls[of] | (chunk.ids[owner] < chunk.ids[of]))
            gone[order] = here | np.repeat(np.concatenate(owned), runs)
        n = len(words.starts)
        edge = np.zeros(n + 1, np.int64)
        np.add.at(edge, at[gone], 1)
        np.add.at(edge, at[gone] + size, -1)
        dead = np.cumsum(edge[:-1]) > 0
        longest = np.zeros(len(chunk.ids), np.int64)
        longest[doc[at]] = size
        found, more = longer(words, rolling, at, doc)
        repeated = np.concatenate(shared)[coded(more)[1]] if len(more) else np.zeros(0, bool)
        half = np.zeros(n + 1, bool)
        half[at] = True
        for (length, start), good in zip(found, np.split(repeated, np.cumsum([len(a) for _, a in found])[:-1]) if found else [], strict=True):
            start = start[good & half[start] & half[start + length // 2]]
            half[:] = False
            half[start] = True
            longest[doc[start]] = length
        return _digest(chunk, words, doc, dead, longest, with_text)

    asked = C.answer(C.send(stored, emit_filter), merge_filter)
    return C.finish(stored, C.answer(C.send_again(stored, asked, emit_windows), merge_windows), last, SCHEMA)


def _digest(chunk: C.Chunk, words: Words, doc: np.ndarray, dead: np.ndarray, longest: np.ndarray, with_text: bool) -> pa.Table:
    """The rows of a chunk's documents, given which words go."""
    docs = len(chunk.ids)
    kept = ~dead
    starts, ends = words.starts[kept], words.ends[kept]
    owner = doc[kept]
    n_words = words.counts
    n_kept = np.bincount(owner, minlength=docs)
    size = np.bincount(owner, weights=ends - starts, minlength=docs).astype(np.int64) + np.maximum(n_kept - 1, 0)
    at = np.concatenate([[0], np.cumsum(size)])
    # where each kept word begins in the joined text: one space after all but a document's last
    step = ends - starts + 1
    begin = np.cumsum(step) - step - (owner - np.concatenate([[0], np.cumsum(n_kept == 0)])[owner])
    out = np.full(at[-1], 0x20, np.uint8)

    def between(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
        edge = np.zeros(n + 1, np.int8)
        edge[a] += 1
        np.subtract.at(edge, b, 1)
        return np.cumsum(edge[:-1], dtype=np.int8).astype(bool)

    out[between(begin, begin + ends - starts, len(out))] = chunk.data[between(starts, ends, len(chunk.data))]
    raw = out.tobytes()
    spans = dead & ~np.concatenate([[False], dead[:-1] & (doc[1:] == doc[:-1])]) if len(dead) else dead
    return pa.table(
        [
            chunk.id_column(),
            pa.array(n_words.astype(np.int64)),
            pa.array((n_words - n_kept).astype(np.int64)),
            pa.array(np.bincount(doc[spans], minlength=docs).astype(np.int64)),
            pa.array(longest),
            pa.Array.from_buffers(pa.string(), docs, [None, pa.py_buffer(at.astype(np.int32)), pa.py_buffer(raw)]) if with_text else pa.nulls(docs, pa.string()),
            pa.array([hashlib.sha256(raw[a:b]).hexdigest() for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)], pa.string()),
        ],
        names=["doc_id", "n_words", "n_removed", "n_spans", "longest", "kept_text", "kept_sha256"],
    )
