"""Exact dedup by counting quotient filters (operator 1).

1. One scan hashes each normalised text (A-Z lower-cased, nothing else): a 64-bit fingerprint and
   its SHA-256. These narrow rows are written to the shared folder.
2. Each partition of them builds a counting quotient filter. Filters meet by bucket of the
   hash space and merge losslessly by sorted remainders: a fingerprint's count is exact.
3. Fingerprints with a count above one go to byte verification: texts are grouped by their bytes,
   pre-aggregated in every task, so a group with a third of all rows arrives as a row a task.
   A bitmap of eight bits or more for each repeated fingerprint (2**``MOST_BITS`` bits, 128 MB, at most) keeps most other texts from
   being shuffled; it only ever lets more through.

Of equal texts one row stays: that of the largest doc_id (a null one is the smallest); among rows
that repeat it, one. Null counts as the empty text. Very long texts are hashed and grouped whole. An empty table gives an empty result. Only the named
columns are read, so others may have any name.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from galley.llm.quotient import CountingQuotientFilter as CQF
from galley.llm.quotient import bucket_bits
from galley.llm.scratch import materialize, shuffle_partitions

U = np.uint64
LEAST_BITS, MOST_BITS = 22, 30
_SLICE = 19  # bits of the route bitmap in one row, as a power of two


def normalise(texts: pa.Array) -> pa.Array:
    return pc.ascii_lower(texts.cast(pa.large_string()).fill_null(""))


def _hash(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        raw = [x.as_buffer() for x in normalise(b.column(1))]
        yield pa.RecordBatch.from_arrays(
            [
                b.column(0),
                b.column(2),
                pa.array(np.array([xxhash.xxh3_64_intdigest(x) for x in raw], U).view(np.int64)),
                pa.array([hashlib.sha256(x).digest() for x in raw], pa.binary()),
            ],
            names=["id", "row", "fp", "sha"],
        )


def repeated_fingerprints(hashed: DataFrame) -> DataFrame:
    """Fingerprints (column fp) that more than one row has, by merging filters of the partitions."""
    bits = bucket_bits(shuffle_partitions(hashed.sparkSession))

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def flush():
            parts = CQF.build(np.concatenate(held), 64).split(bits)
            full = [(k, x.to_bytes()) for k, x in enumerate(parts) if len(x.keys)]
            return pa.RecordBatch.from_arrays([pa.array([k for k, _ in full], pa.int32()), pa.array([x for _, x in full], pa.binary())], names=["bucket", "body"])

        for b in batches:
            held.append(b.column(0).to_numpy().view(U))
            size += b.num_rows
            if size >= 4_000_000:  # another filter of the same partition: merging doesn't mind
                yield flush()
                held, size = [], 0
        if size:
            yield flush()

    def merge(table: pa.Table) -> pa.Table:
        bucket = table["bucket"][0].as_py()
        whole = CQF.merge([CQF.from_bytes(x) for x in table["body"].to_pylist()])
        keys = whole.keys[whole.counts > 1] | U(bucket << (64 - bits) if bits else 0)
        return pa.table([pa.array(keys.view(np.int64))], names=["fp"])

    return hashed.select("fp").mapInArrow(build, "bucket int, body binary").groupBy("bucket").applyInArrow(merge, "fp bigint")


def route_bitmap(repeated: DataFrame) -> tuple[bytes, int]:
    """A bitmap of the fingerprints' high bits, joined slice by slice on the executors, and the logarithm of its size."""
    wide = min(MOST_BITS, max(LEAST_BITS, (8 * repeated.count()).bit_length()))

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at = np.unique(b.column(0).to_numpy().view(U) >> U(64 - wide)).astype(np.int64)
            full, begin = np.unique(at >> _SLICE, return_index=True)
            bodies = []
            for part in np.split(at & ((1 << _SLICE) - 1), begin[1:]):
                bits = np.zeros(1 << _SLICE, bool)
                bits[part] = True
                bodies.append(np.packbits(bits).tobytes())
            if len(full):
                yield pa.RecordBatch.from_arrays([pa.array(full.astype(np.int32)), pa.array(bodies, pa.binary())], names=["slice", "body"])

    def either(table: pa.Table) -> pa.Table:
        out = np.bitwise_or.reduce([np.frombuffer(x, np.uint8) for x in table["body"].to_pylist()])
        return pa.table([table["slice"][:1], pa.array([out.tobytes()], pa.binary())], names=["slice", "body"])

    out = np.zeros((1 << (wide - _SLICE), 1 << (_SLICE - 3)), np.uint8)
    for r in repeated.mapInArrow(mark, "slice int, body binary").groupBy("slice").applyInArrow(either, "slice int, body binary").collect():
        out[r.slice] = np.frombuffer(r.body, np.uint8)
    return out.tobytes(), wide


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", row_col: str | None = None) -> DataFrame:
    """One row a document: doc_id, keep_id, group_size, kept, text_sha256 (of the normalised text), and row: the
    column row_col, which must tell rows apart, or a number of ours."""
    spark = docs.sparkSession
    pair = docs.select(docs[id_col].cast("bigint").alias("id"), docs[text_col].alias("text"), (docs[row_col] if row_col else F.monotonically_increasing_id()).alias("row"))
    hashed = materialize(pair.mapInArrow(_hash, "id bigint, row bigint, fp bigint, sha binary"), "hashed")
    repeated = materialize(repeated_fingerprints(hashed), "repeated")
    route = spark.sparkContext.broadcast(route_bitmap(repeated))

    def candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        body, wide = route.value
        bits = np.frombuffer(body, np.uint8)
        for b in batches:
            texts = normalise(b.column(0))
            fp = np.array([xxhash.xxh3_64_intdigest(x.as_buffer()) for x in texts], U)
            at = fp >> U(64 - wide)
            some = np.flatnonzero((bits[at >> U(3)] >> (U(7) - (at & U(7))).astype(np.uint8)) & 1)
            if len(some):
                chosen = texts.take(pa.array(some))
                yield pa.RecordBatch.from_arrays([pa.array(fp[some].view(np.int64)), chosen.cast(pa.string())], names=["fp", "text"])

    verified = (
        pair.select("text").mapInArrow(candidates, "fp bigint, text string")
        .groupBy("fp", "text").agg(F.count(F.lit(1)).alias("n"))
        .select("fp", F.unhex(F.sha2("text", 256)).alias("sha"))
        .groupBy("fp", "sha").agg(F.count(F.lit(1)).alias("n_texts"))
    )
    groups = materialize(
        hashed.join(repeated, "fp", "left_semi")
        .groupBy("fp", "sha").agg(F.max(F.struct("id", "row")).alias("keep"), F.count(F.lit(1)).alias("size"))
        .join(verified, ["fp", "sha"])
        .select("fp", "sha", "keep", F.when(F.col("n_texts") == 1, F.col("size")).otherwise(F.raise_error(F.lit("two texts share a SHA-256")).cast("bigint")).alias("size")),
        "groups",
    )  # fmt: skip  # written, so that Spark can split a large group's rows in the last join
    return hashed.join(groups, ["fp", "sha"], "left").select(
        F.col("id").alias("doc_id"),
        F.when(F.col("size").isNull(), F.col("id")).otherwise(F.col("keep.id")).alias("keep_id"),
        F.coalesce("size", F.lit(1)).cast("bigint").alias("group_size"),
        (F.col("size").isNull() | (F.col("keep.row") == F.col("row"))).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"),
        "row",
    )
