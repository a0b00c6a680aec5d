"""Chunks of documents that ask questions of hash buckets.

Corpus statistics of windows, shingles or n-grams are far larger than the text. Rather than
shuffling a row for each, documents are dealt once into chunks of about CHUNK_BYTES. A chunk sends each
bucket of the hash space one filter of its distinct fingerprints (so a word or passage that a
third of all rows share arrives once a chunk, however often it occurs), the bucket merges the
filters, and answers each in the order of its keys. Chunk and answers meet by chunk id.

Everything is lazy and in one plan, so the exchange of the text is made once and reused, and a lost executor costs the tasks that it ran.
The numbers of chunks and buckets follow the bytes of the input (one aggregate over it), so what a task holds at once is the
same at any size; a chunk sends no block where it has no key, so blocks are never more than distinct keys of chunks.

Rows are dealt by a hash of doc_id, text and, among equal rows, their place: no doc_id, null ones included, and no text gathers in one
chunk. The doc_id is only data, with a flag for null. A document is never split, so a chunk is as large as its longest document at least.
"""

from __future__ import annotations

import struct
from collections.abc import Callable, Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from galley.llm.quotient import bucket_bits
from galley.llm.scratch import shuffle_partitions
from galley.llm.words import mix, text_buffers, trim

STORE = "chunk int, ids binary, nulls binary, sizes binary, body binary"
BLOCK = "bucket int, chunk int, body binary"
ANSWER = "chunk int, bucket int, body binary"
CHUNK_BYTES = 8 << 20
#: Bytes of text whose keys one bucket holds, on average.
BUCKET_BYTES = 16 << 20
#: Small inputs get more chunks and buckets, so that all tasks have work; but none for less than this.
LEAST_BYTES = 1 << 19


class Layout(NamedTuple):
    rows: int
    chunks: int
    bits: int  # the logarithm of the number of buckets


def layout(docs: DataFrame, text_col: str) -> Layout:
    """How many rows there are, and the chunks and buckets for them."""
    rows, size = docs.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.octet_length(docs[text_col]).cast("bigint")), F.lit(0))).first()
    size += 64 * rows
    tasks = shuffle_partitions(docs.sparkSession)
    up = lambda n: -(-size // n)
    return Layout(rows, max(1, up(CHUNK_BYTES), min(2 * tasks, up(LEAST_BYTES))), bucket_bits(max(1, up(BUCKET_BYTES), min(tasks, up(LEAST_BYTES)))))


class Chunk:
    """Documents of a chunk sorted by (id, text length), null ids last: ids (int64), nulls, text bytes and offsets."""

    def __init__(self, table: pa.Table):
        unzip = zstandard.ZstdDecompressor()
        whole = lambda column, kind: np.frombuffer(b"".join(table[column].to_pylist()), kind)
        ids, nulls, sizes = whole("ids", np.int64), whole("nulls", bool), whole("sizes", np.int64)
        data = np.frombuffer(b"".join(unzip.decompress(x) for x in table["body"].to_pylist() if len(x)), np.uint8)
        starts = np.cumsum(sizes) - sizes
        order = np.lexsort((sizes, ids, nulls))
        self.ids, self.nulls, sizes = ids[order], nulls[order], sizes[order]
        self.offsets = np.concatenate([[0], np.cumsum(sizes)])
        self.data = np.empty(len(data), np.uint8)
        for i, k in enumerate(order.tolist()):
            self.data[self.offsets[i] : self.offsets[i + 1]] = data[starts[k] : starts[k] + sizes[i]]

    def id_column(self) -> pa.Array:
        return pa.array(self.ids, mask=self.nulls)


def trimmed(table: pa.Table) -> pa.Table:
    trim()
    return table


def _deal(ids: np.ndarray, nulls: np.ndarray, texts: np.ndarray, chunks: int) -> np.ndarray:
    """The chunk of each row: by id and text; equal rows take turns."""
    h = mix(ids.view(np.uint64) ^ mix(texts + nulls.astype(np.uint64)))
    order = np.argsort(h, kind="stable")
    new = np.flatnonzero(np.concatenate([[True], h[order][1:] != h[order][:-1]]))
    turn = np.empty(len(h), np.uint64)
    turn[order] = np.arange(len(h)) - np.repeat(new, np.diff(np.append(new, len(h))))
    return (mix(h + turn) % np.uint64(chunks)).astype(np.int64)


def store(docs: DataFrame, id_col: str, text_col: str, chunks: int) -> DataFrame:
    """Documents packed by chunk: one row for each chunk and input batch."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        z = zstandard.ZstdCompressor(level=1)
        held: list[tuple] = []
        size = 0

        def flush():
            ids, nulls, sizes = (np.concatenate([x[i] for x in held]) for i in (0, 1, 3))
            data = np.concatenate([x[2] for x in held])
            starts = np.cumsum(sizes) - sizes
            texts = np.array([xxhash.xxh3_64_intdigest(data[a : a + n]) for a, n in zip(starts.tolist(), sizes.tolist(), strict=True)], np.uint64)
            chunk = _deal(ids, nulls, texts, chunks)
            order = np.argsort(chunk, kind="stable")
            edges = np.flatnonzero(np.diff(chunk[order])) + 1
            rows = {"chunk": [], "ids": [], "nulls": [], "sizes": [], "body": []}
            for part in np.split(order, edges):
                rows["chunk"].append(int(chunk[part[0]]))
                rows["ids"].append(ids[part].tobytes())
                rows["nulls"].append(nulls[part].tobytes())
                rows["sizes"].append(sizes[part].tobytes())
                rows["body"].append(z.compress(b"".join(data[starts[k] : starts[k] + sizes[k]].tobytes() for k in part.tolist())))
            held.clear()
            return pa.RecordBatch.from_pydict(rows, pa.schema([("chunk", pa.int32())] + [(c, pa.binary()) for c in ("ids", "nulls", "sizes", "body")]))

        for b in batches:
            if not b.num_rows:
                continue
            data, offsets = text_buffers(b.column(1))
            ids = b.column(0).cast(pa.int64())
            held.append((ids.fill_null(0).to_numpy(zero_copy_only=False), ids.is_null().to_numpy(zero_copy_only=False), data.copy(), np.diff(offsets)))
            size += len(data)
            if size >= 32 << 20:
                yield flush()
                size = 0
        if held:
            yield flush()

    return docs.select(docs[id_col], docs[text_col]).mapInArrow(pack, STORE)


def blocks(rows: list[tuple[int, int, bytes]], names: tuple[str, ...]) -> pa.Table:
    a, b, c = zip(*rows, strict=True) if rows else ((), (), ())
    return pa.table([pa.array(a, pa.int32()), pa.array(b, pa.int32()), pa.array(c, pa.binary())], names=list(names))


def send(stored: DataFrame, emit: Callable[[int, Chunk], Iterable[tuple[int, bytes]]]) -> DataFrame:
    """Blocks of each chunk: emit gives (bucket, body)."""

    def run(table: pa.Table) -> pa.Table:
        k = table["chunk"][0].as_py()
        return trimmed(blocks([(b, k, x) for b, x in emit(k, Chunk(table))], ("bucket", "chunk", "body")))

    return stored.groupBy("chunk").applyInArrow(run, BLOCK)


def send_again(stored: DataFrame, answers: DataFrame, emit: Callable[..., Iterable[tuple[int, bytes]]]) -> DataFrame:
    """As send, with the answers that the chunk got before, by bucket, and where answers have totals, those."""
    totals = "n" in answers.columns

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows:
            return blocks([], ("bucket", "chunk", "body"))
        k = left["chunk"][0].as_py()
        more = [(right["n"][0].as_py(), right["v"][0].as_py())] if totals else []
        return trimmed(blocks([(b, k, x) for b, x in emit(k, Chunk(left), by_bucket(right), *more)], ("bucket", "chunk", "body")))

    return stored.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(run, BLOCK)


def by_bucket(answers: pa.Table) -> dict[int, bytes]:
    return dict(zip(answers["bucket"].to_pylist(), answers["body"].to_pylist(), strict=True))


def answer(sent: DataFrame, merge: Callable[[list[bytes]], list[bytes]]) -> DataFrame:
    """merge gets all blocks of a bucket, by rising chunk, and gives an answer to each. Blocks of negative buckets
    are notes of a chunk to itself and pass unchanged."""

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("chunk")  # the same order, should the task run again
        bucket = table["bucket"][0].as_py()
        chunk, bodies = table["chunk"].to_pylist(), table["body"].to_pylist()
        out = bodies if bucket < 0 else merge(bodies)
        return trimmed(blocks([(k, max(bucket, -1), x) for k, x in zip(chunk, out, strict=True)], ("chunk", "bucket", "body")))

    return sent.groupBy("bucket").applyInArrow(run, ANSWER)


def answer_and_total(sent: DataFrame, merge: Callable[[list[bytes]], tuple[list[bytes], tuple[int, int]]]) -> DataFrame:
    """As answer; merge gives two numbers of the bucket, too, and their sums over all buckets come with every answer as columns n, v.
    So no chunk need hear from a bucket to which it sent nothing."""

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("chunk")
        bucket = table["bucket"][0].as_py()
        out, (n, v) = merge(table["body"].to_pylist())
        rows = [(k, bucket, x, 0, 0) for k, x in zip(table["chunk"].to_pylist(), out, strict=True)] + [(-1, bucket, b"", n, v)]
        kinds = (pa.int32(), pa.int32(), pa.binary(), pa.int64(), pa.int64())
        return trimmed(pa.table([pa.array(x, kind) for x, kind in zip(zip(*rows, strict=True), kinds, strict=True)], names=["chunk", "bucket", "body", "n", "v"]))

    both = sent.groupBy("bucket").applyInArrow(run, ANSWER + ", n bigint, v bigint")
    totals = both.filter("chunk < 0").agg(F.sum("n").alias("n"), F.sum("v").alias("v"))
    return both.filter("chunk >= 0").drop("n", "v").crossJoin(F.broadcast(totals))  # one row


def note(chunk: int, body: bytes) -> tuple[int, bytes]:
    """A block that comes back to the chunk as bucket -1."""
    return -1 - chunk, body


def finish(stored: DataFrame, answers: DataFrame, last: Callable[[Chunk, dict[int, bytes]], pa.Table], schema: str) -> DataFrame:
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        return trimmed(last(Chunk(left), by_bucket(right)))

    return stored.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(run, schema)


def pack_bits(bits: np.ndarray) -> bytes:
    return struct.pack("<I", len(bits)) + np.packbits(bits).tobytes()


def unpack_bits(body: bytes, at: int = 0) -> np.ndarray:
    (n,) = struct.unpack_from("<I", body, at)
    return np.unpackbits(np.frombuffer(body, np.uint8, (n + 7) // 8, at + 4), count=n).astype(bool)


def read_bits(answers: dict[int, bytes]) -> np.ndarray:
    """Answers of one bit a key, in the order of all keys."""
    parts = [unpack_bits(answers[b]) for b in sorted(answers) if b >= 0]
    return np.concatenate(parts) if parts else np.zeros(0, bool)
