"""Packing by power-of-two decomposition (operator 9).

A document of n ids is cut into pieces of at most ``max_length`` (a power of two): as many whole
ones as fit, then the binary digits of the rest, largest first. Every piece is a sequence of its own, so no
sequence crosses documents and none needs padding; sequences of equal length form a bucket.

Ids are those of the tokenizer on the whole text. Its pre-tokenizer splits at white space, and no
rule of it looks across, so each distinct word is encoded once a worker and then looked up by
its 64-bit hash; tests compare with encoding whole texts.

Null and empty texts give the end id alone, a piece of length 1. Rows with null or repeated doc_id
are packed like others. An empty table gives an empty result.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame

from galley.llm.words import Words, trim

U = np.uint64
END_ID = 2
SCHEMA = "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint, bucket int"
#: Words that a worker remembers; beyond, it forgets all and goes on.
REMEMBERED = 2_000_000
_encoders: dict[str, "WordEncoder"] = {}


class WordEncoder:
    """Token ids of words by hash, for tokenizers that never look across white space."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self._clear()

    def _clear(self) -> None:
        self.keys, self.at, self.size = np.zeros(0, U), np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.ids: list[np.ndarray] = []
        self.flat, self.filled = np.zeros(1 << 20, np.uint32), 0

    def _encode_new(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the words one after the other, and how many each has."""
        ids, counts = [], []
        for k in range(0, len(words), 20_000):
            part = words[k : k + 20_000]
            e = self.tokenizer.encode(" ".join(part), add_special_tokens=False)
            starts = np.cumsum([0] + [len(w) + 1 for w in part])
            offsets = np.array(e.offsets, np.int64).reshape(-1, 2)[:, 0]
            counts.append(np.bincount(np.searchsorted(starts, offsets, side="right") - 1, minlength=len(part)))
            ids.append(np.array(e.ids, np.uint32))
        return np.concatenate(ids), np.concatenate(counts)

    def encode(self, words: Words) -> tuple[np.ndarray, np.ndarray]:
        """All ids in order of the words, and how many ids each word has."""
        if not len(words.hashes):
            return np.zeros(0, np.uint32), np.zeros(0, np.int64)
        keys, first, code = np.unique(words.hashes, return_index=True, return_inverse=True)
        if len(self.keys) > REMEMBERED:
            self._clear()
        spot = np.searchsorted(self.keys, keys)
        new = np.ones(len(keys), bool) if not len(self.keys) else self.keys[np.minimum(spot, len(self.keys) - 1)] != keys
        if new.any():
            i = first[new]
            data = words.data
            fresh, counts = self._encode_new([data[a:b].tobytes().decode() for a, b in zip(words.starts[i].tolist(), words.ends[i].tolist(), strict=True)])
            if self.filled + len(fresh) > len(self.flat):
                self.flat = np.concatenate([self.flat[: self.filled], np.zeros(max(len(fresh), self.filled), np.uint32)])
            self.flat[self.filled : self.filled + len(fresh)] = fresh
            at = self.filled + np.cumsum(counts) - counts
            self.filled += len(fresh)
            merged = np.concatenate([self.keys, keys[new]])
            order = np.argsort(merged, kind="stable")
            self.keys, self.at, self.size = merged[order], np.concatenate([self.at, at])[order], np.concatenate([self.size, counts])[order]
            spot = np.searchsorted(self.keys, keys)
        size, at = self.size[spot][code], self.at[spot][code]
        ends = np.cumsum(size)
        return self.flat[np.arange(ends[-1]) + np.repeat(at - (ends - size), size)], size


def encoder(path: str) -> WordEncoder:
    if path not in _encoders:
        _encoders[path] = WordEncoder(path)
    return _encoders[path]


def _slices(column: pa.Array, size: int = 4 << 20) -> Iterator[tuple[int, pa.Array]]:
    """Runs of whole rows of about size bytes."""
    sizes = np.cumsum([x or 0 for x in pc.binary_length(column).to_pylist()])
    at = 0
    while at < len(column):
        stop = max(at + 1, int(np.searchsorted(sizes, (sizes[at - 1] if at else 0) + size, side="right")))
        yield at, column.slice(at, stop - at)
        at = stop


def cuts(totals: np.ndarray, max_length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Document index, start and length of all pieces of documents of so many ids."""
    whole = totals // max_length
    digits = [1 << k for k in range(max_length.bit_length() - 2, -1, -1)]
    has = ((totals[:, None] & np.array(digits, np.int64)) > 0) if digits else np.zeros((len(totals), 0), bool)
    count = whole + has.sum(1)
    doc = np.repeat(np.arange(len(totals)), count)
    nth = np.arange(len(doc)) - np.repeat(np.cumsum(count) - count, count)
    length = np.full(len(doc), max_length, np.int64)
    length[nth >= whole[doc]] = np.broadcast_to(np.array(digits, np.int64), has.shape)[has]
    start = np.cumsum(length) - length
    return doc, start - np.repeat(np.cumsum(totals) - totals, count), length


def pack_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: str | None = None, max_length: int = 4096, end_id: int = END_ID) -> DataFrame:
    """One row a piece, which is a sequence: doc_id, start, length, ids_crc32, doc_tokens, sequence_id,
    offset (0), bucket (log2 of the length). sequence_ids are unique and ascend by bucket, then by
    partition; they have gaps, as no task waits for another's count."""
    if max_length < 1 or max_length & (max_length - 1):
        raise ValueError("max_length must be a power of two")
    path = vocabulary or public_tokenizers.path("word_bpe_49k.json")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path)
        base = TaskContext.get().partitionId() << 30
        made = np.zeros(max_length.bit_length(), np.int64)
        for batch in batches:
            for at, texts in _slices(batch.column(1)):
                words = Words.of(texts)
                ids, size = encode.encode(words)
                per_doc = np.diff(np.concatenate([[0], np.cumsum(size)])[words.first])
                totals = per_doc + 1
                ends = np.cumsum(totals)
                flat = np.full(int(ends[-1]), end_id, "<u4")
                inside = np.ones(len(flat), bool)
                inside[ends - 1] = False
                flat[inside] = ids
                doc, start, length = cuts(totals, max_length)
                raw = memoryview(flat.tobytes())
                begin = (ends - totals)[doc] + start
                crc = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(begin.tolist(), (begin + length).tolist(), strict=True)]
                bucket = np.log2(length).astype(np.int64)
                order = np.argsort(bucket, kind="stable")
                counts = np.bincount(bucket, minlength=len(made))
                nth = np.empty(len(bucket), np.int64)
                nth[order] = np.arange(len(bucket)) - np.repeat(np.cumsum(counts) - counts, counts)
                sequence = (bucket << 56) | (base + made[bucket] + nth)
                made += counts
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(at, len(texts)).take(pa.array(doc)),
                        *(pa.array(x) for x in (start, length, np.array(crc, np.int64), totals[doc], sequence, np.zeros(len(doc), np.int64))),
                        pa.array(bucket.astype(np.int32)),
                    ],
                    names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "bucket"],
                )
            trim()

    return docs.select(docs[id_col].cast("bigint"), docs[text_col]).mapInArrow(run, SCHEMA)
