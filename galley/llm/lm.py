"""LM scoring with an Elias-Fano n-gram trie (operator 6).

The model is a bigram model over words and an end token, smoothed with add-half unigrams P(w) = (c(w) + 0.5)/(N + 0.5 (V + 1)):
P(w|v) = (c(v,w) + m P(w))/(c(v) + m), m = 2 c(v)^0.8. That is Witten-Bell smoothing with Heaps' law for the number of
different successors. The context of a document's first token is the end token. All counts are exact and over all training documents.

Counts live in hash buckets. A chunk first asks the unigram buckets for the counts of its words,
then sends its distinct pairs to the pair buckets, which deal by a hash of both words, so a
word or pair that a third of all rows share costs a bucket one entry a chunk. A
pair bucket merges its pairs into a trie of smoothed, quantised probabilities, one byte each, memory-maps it, and answers by successor search
within the range that the context's pointers give. Quantising rounds down (steps of 10^-0.04; P(w) in it in steps of 2^(1/6)), so P sums to at most 1 for every context. A pair that is
not in the trie, or below its least code, gets the context's backoff m P(w)/(c(v) + m).

A trie is part of one job: nothing but its codes leaves the task. Words are told apart by 64 bits, pairs in a bucket by 48 of the context and 40 of the word.

Null texts count as empty: only the end token. A null doc_id counts as the text ''. With no training tokens N and V are 0.
Equal doc_ids fall on the same side, repeated rows count as often as they are there. A very long text is scored whole, in one chunk. An empty table
gives an empty result. Only the two named columns are read, so others may have any name.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from galley.llm import chunks as C
from galley.llm.elias_fano import BigramTrie, MappedTrie
from galley.llm.quotient import CountingQuotientFilter as CQF
from galley.llm.quotient import pack_counts, pack_keys, unpack_counts, unpack_keys
from galley.llm.words import Words, mix

U = np.uint64
END = U(0xE17D0C0FFEE5EED1)
STEP = 0.04
LEFT = U(64 - BigramTrie.CONTEXT_BITS)
RIGHT = U(64 - BigramTrie.ID_BITS)
SCHEMA = "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double, n_pairs_known bigint"


def held_out(chunk: C.Chunk, fold: int, folds: int) -> np.ndarray:
    return np.array([zlib.crc32(b"" if null else str(x).encode()) % folds == fold for x, null in zip(chunk.ids.tolist(), chunk.nulls.tolist(), strict=True)], bool)


def quantise(p: np.ndarray) -> np.ndarray:
    """255 for p = 1, each step down a factor 10**-STEP, rounded down; 0 for less than the least step."""
    return np.clip(255 - np.ceil(-np.log10(p) / STEP - 1e-9), 0, 255).astype(np.uint8)


def dequantise(codes: np.ndarray) -> np.ndarray:
    table = 10.0 ** (-STEP * (255 - np.arange(256.0)))
    table[0] = 0
    return table[codes]


def spread(count: np.ndarray) -> np.ndarray:
    """m: the pseudo-count of a context's unseen successors."""
    return 2.0 * np.asarray(count, float) ** 0.8


def coarse(count: np.ndarray) -> np.ndarray:
    """Count plus a half in a byte, rounded down to a step of 2**(1/6)."""
    return np.floor(6 * np.log2(count + 0.5) + 6 + 1e-9).astype(np.uint8)


def uncoarse(code: np.ndarray) -> np.ndarray:
    return 2.0 ** ((code.astype(float) - 6) / 6)


def pack_ints(a: np.ndarray) -> bytes:
    """Integers of at least zero in byte planes."""
    wide = max(1, (int(a.max(initial=0)).bit_length() + 7) // 8)
    return struct.pack("<IB", len(a), wide) + np.ascontiguousarray(a.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :wide].T).tobytes()


def unpack_ints(body: bytes, at: int) -> tuple[np.ndarray, int]:
    n, wide = struct.unpack_from("<IB", body, at)
    out = np.zeros((n, 8), np.uint8)
    out[:, :wide] = np.frombuffer(body, np.uint8, n * wide, at + 5).reshape(wide, n).T
    return out.view(np.int64).ravel(), at + 5 + n * wide


class Tokens:
    """Tokens of a chunk: hashes with an end token after each document, and their document."""

    def __init__(self, chunk: C.Chunk):
        words = Words(chunk.data, chunk.offsets, lower=True)
        docs = len(chunk.ids)
        size = words.counts + 1
        self.ends = np.cumsum(size)
        self.hashes = np.full(int(self.ends[-1]) if docs else 0, END, U)
        inside = np.ones(len(self.hashes), bool)
        inside[self.ends - 1] = False
        self.hashes[inside] = words.hashes
        self.size = size
        self.doc = np.repeat(np.arange(docs), size)


class Pairs:
    """Distinct (context, token) pairs of a chunk in the order of buckets."""

    def __init__(self, tokens: Tokens, bits: int):
        self.words, code = np.unique(tokens.hashes, return_inverse=True)
        n = len(self.words)
        previous = np.empty_like(code)
        previous[1:] = code[:-1]
        if len(code):
            previous[0] = np.searchsorted(self.words, END)
        self.code, self.previous = code, previous
        self.pair = previous * max(1, n) + code
        self.n, self.bits = max(1, n), bits

    def order(self, distinct: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        a, b = distinct // self.n, distinct % self.n
        g = mix(self.words[a] * U(0x9E3779B97F4A7C15) ^ self.words[b]) if len(a) else np.zeros(0, U)
        bucket = (g >> U(64 - self.bits)).astype(np.int64) if self.bits else np.zeros(len(a), np.int64)
        order = np.argsort(bucket.astype(np.uint16) if self.bits <= 16 else bucket, kind="stable")
        return a, b, bucket, order


def _counts(answers: dict[int, bytes]) -> np.ndarray:
    parts = [unpack_counts(answers[b], struct.unpack_from("<I", answers[b])[0], 4)[0] for b in sorted(answers) if b >= 0]
    return np.concatenate(parts) if parts else np.zeros(0, np.int64)


def score_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", fold: int = 1, folds: int = 5) -> DataFrame:
    """One row a document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, n_pairs_known.
    Documents with crc32(doc_id as text) mod folds equal to fold are held out; the rest train the model."""
    _, chunks, bits = C.layout(docs, text_col)
    stored = C.store(docs, id_col, text_col, chunks)

    def emit_words(_, chunk: C.Chunk):
        tokens = Tokens(chunk)
        train = (~held_out(chunk, fold, folds)).astype(np.int64)
        for b, part in enumerate(CQF.build(tokens.hashes, 64, train[tokens.doc]).split(bits)):
            if len(part.keys):
                yield b, part.to_bytes()

    def merge_words(bodies: list[bytes]) -> tuple[list[bytes], tuple[int, int]]:
        filters = [CQF.from_bytes(x) for x in bodies]
        sums = CQF.totals(filters)
        keys = np.concatenate([f.keys for f in filters])
        n, v = sum(int(f.counts.sum()) for f in filters), len(np.unique(keys[np.concatenate(sums) > 0]))
        return [struct.pack("<I", len(x)) + pack_counts(x) for x in sums], (n, v)

    def emit_pairs(k: int, chunk: C.Chunk, answers: dict[int, bytes], totals: tuple[int, int]):
        tokens = Tokens(chunk)
        count = _counts(answers)
        pairs = Pairs(tokens, bits)
        train = ~held_out(chunk, fold, folds)
        both = np.sort((pairs.pair << 1) | train[tokens.doc])
        start = np.flatnonzero(np.concatenate([[True], both[1:] >> 1 != both[:-1] >> 1])) if len(both) else np.zeros(0, np.int64)
        seen = np.add.reduceat(both & 1, start) if len(start) else start
        a, b, bucket, order = pairs.order(both[start] >> 1)
        edges = np.searchsorted(bucket[order], np.arange(1, 1 << bits))
        for j, part in enumerate(np.split(order, edges)):
            if not len(part):
                continue
            left, right = pairs.words[a[part]] >> LEFT, pairs.words[b[part]] >> RIGHT
            first = np.flatnonzero(np.concatenate([[True], a[part][1:] != a[part][:-1]]))
            runs = np.diff(np.append(first, len(part)))
            index = np.repeat(np.arange(len(first)), runs)
            wide = BigramTrie.ID_BITS + max(1, len(first)).bit_length()
            yield (
                j,
                struct.pack("<QQ", *totals) + pack_keys(left[first], BigramTrie.CONTEXT_BITS) + pack_ints(count[a[part][first]])
                + pack_keys((index.astype(U) << U(BigramTrie.ID_BITS)) | right, wide) + pack_counts(seen[part]) + coarse(count[b[part]]).tobytes(),
            )
        yield C.note(k, struct.pack("<QQI", *totals, len(count)) + pack_counts(count))

    def merge_pairs(bodies: list[bytes]) -> list[bytes]:
        blocks = []
        for x in bodies:
            total, types = struct.unpack_from("<QQ", x)
            left, at = unpack_keys(x, 16)
            c1, at = unpack_ints(x, at)
            keys, at = unpack_keys(x, at)
            seen, at = unpack_counts(x, len(keys), at)
            index = (keys >> U(BigramTrie.ID_BITS)).astype(np.int64)
            blocks.append((left[index], keys & U((1 << BigramTrie.ID_BITS) - 1), c1[index], seen, np.frombuffer(x, np.uint8, len(keys), at)))
        left, right, c1, seen, rough = (np.concatenate(c) for c in zip(*blocks, strict=True))
        contexts, index = np.unique(left, return_inverse=True)
        key = (index.astype(U) << U(BigramTrie.ID_BITS)) | right
        order = np.argsort(key, kind="stable")
        ks = key[order]
        start = np.flatnonzero(np.concatenate([[True], ks[1:] != ks[:-1]])) if len(ks) else np.zeros(0, np.int64)
        c12 = np.add.reduceat(seen[order], start) if len(start) else start
        c1, rough, key = c1[order][start], rough[order][start], ks[start]
        context, successor = contexts[(key >> U(BigramTrie.ID_BITS)).astype(np.int64)], key & U((1 << BigramTrie.ID_BITS) - 1)
        have = c12 > 0
        m = spread(c1[have])
        p = (c12[have] + m * uncoarse(rough[have]) / (total + 0.5 * (types + 1))) / (np.maximum(c1[have], c12[have]) + m)
        with MappedTrie(BigramTrie.pack(context[have], successor[have], quantise(p))) as trie:
            codes = trie.lookup(context, successor)
        out = np.empty(len(order), np.uint8)
        out[order] = np.repeat(codes, np.diff(np.append(start, len(order))))
        return [x.tobytes() for x in np.split(out, np.cumsum([len(b[0]) for b in blocks])[:-1])]

    def last(chunk: C.Chunk, answers: dict[int, bytes]) -> pa.Table:
        tokens = Tokens(chunk)
        total, types, n = struct.unpack_from("<QQI", answers[-1])
        count = unpack_counts(answers[-1], n, 20)[0]
        pairs = Pairs(tokens, bits)
        distinct, where = np.unique(pairs.pair, return_inverse=True)
        _, _, _, order = pairs.order(distinct)
        code = np.empty(len(distinct), np.uint8)
        code[order] = np.concatenate([np.frombuffer(answers[b], np.uint8) for b in sorted(answers) if b >= 0])
        code = code[where]
        unigram = (count + 0.5) / (total + 0.5 * (types + 1))
        c1 = count[pairs.previous]
        m = spread(c1)
        backoff = np.where(c1 > 0, m / np.maximum(1e-9, c1 + m), 1.0)
        p = np.where(code > 0, dequantise(code), backoff * unigram[pairs.code])
        docs = len(chunk.ids)
        sums = lambda x: np.bincount(tokens.doc, x, docs)
        return pa.table(
            [
                chunk.id_column(),
                pa.array(held_out(chunk, fold, folds)),
                pa.array(tokens.size.astype(np.int64)),
                pa.array(sums(count[pairs.code] > 0).astype(np.int64)),
                pa.array(np.full(docs, total, np.int64)),
                pa.array(sums(np.log10(unigram)[pairs.code])),
                pa.array(sums(np.log10(p))),
                pa.array(sums(code > 0).astype(np.int64)),
            ],
            names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score", "n_pairs_known"],
        )

    counted = C.answer_and_total(C.send(stored, emit_words), merge_words)
    looked_up = C.answer(C.send_again(stored, counted, emit_pairs), merge_pairs)
    return C.finish(stored, looked_up, last, SCHEMA)
