"""Sharding by best-fit-decreasing bin packing (operator 10).

Equal texts form an indivisible group. Best-fit-decreasing asks of groups only how many there are of each size: a run of equal
sizes enters the tightest bin until that is full, then the next. So the executors count groups by size, the driver
packs runs, and each group finds its shard by its size and its rank among groups of that size, which executors number
part by part. The sizes differ, so k of them add up to k^2/2 bytes at least: the driver gets at most
sqrt(2 x bytes of the corpus) runs (15 million at 100 TB), and in practice far fewer.

The capacity is the least, within 1/1000 of a mean shard, for which the groups need no more than the shards. A group heavier
than the mean of what is left gets a shard alone.

Sizes: UTF-8 bytes of the text plus 16, null texts counting as empty ones (and grouped with them). A very long text is one row like others. Rows with a
null or repeated doc_id are rows like others; repeated rows stay together. An empty table gives an empty result. Only the two named columns are read, so
others may have any name.
"""

from __future__ import annotations

import random

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from galley.llm.scratch import materialize

ROW_BYTES = 16


class CapacityTree:
    """A treap of (remaining capacity, bin): insert, remove and tightest fit in O(log bins)."""

    def __init__(self) -> None:
        self.root: list | None = None  # [key, priority, left, right]
        self.random = random.Random(0)

    def _split(self, node, key):
        """Nodes below key, and the rest."""
        if node is None:
            return None, None
        if node[0] < key:
            node[3], rest = self._split(node[3], key)
            return node, rest
        less, node[2] = self._split(node[2], key)
        return less, node

    def _merge(self, a, b):
        if a is None or b is None:
            return a or b
        if a[1] > b[1]:
            a[3] = self._merge(a[3], b)
            return a
        b[2] = self._merge(a, b[2])
        return b

    def insert(self, remaining: int, bin_: int) -> None:
        less, more = self._split(self.root, (remaining, bin_))
        self.root = self._merge(self._merge(less, [(remaining, bin_), self.random.random(), None, None]), more)

    def take_tightest(self, size: int) -> tuple[int, int] | None:
        """Remove and return the bin with the least remaining capacity of at least size."""
        less, more = self._split(self.root, (size, -1))
        if more is None:
            self.root = less
            return None
        node = more
        while node[2] is not None:
            node = node[2]
        key = node[0]
        _, rest = self._split(more, (key[0], key[1] + 1))
        self.root = self._merge(less, rest)
        return key


def best_fit_decreasing(sizes: list[int], capacity: int) -> list[int]:
    """The bin of each item: items by falling size enter the tightest open bin that holds them,
    and open one more where none does. An item above the capacity gets a bin alone."""
    tree, bins, out = CapacityTree(), 0, [0] * len(sizes)
    for i in sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)):
        found = tree.take_tightest(sizes[i])
        if found is None:
            found, bins = (max(capacity, sizes[i]), bins), bins + 1
        out[i] = found[1]
        tree.insert(found[0] - sizes[i], found[1])
    return out


def pack_runs(runs: list[tuple[int, int]], capacity: int, bins: int) -> list[tuple[int, int, int, int]] | None:
    """What best_fit_decreasing does with runs (size, count) of falling size: (size, first, end, bin) for the items of a size from
    number first on and before end. None where more bins are needed."""
    tree, used, out = CapacityTree(), 0, []
    for size, count in runs:
        at = 0
        while at < count:
            found = tree.take_tightest(size)
            if found is None:
                if used == bins:
                    return None
                found, used = (max(capacity, size), used), used + 1
            # having been the tightest that fits, it stays so until it is full
            n = min(count - at, found[0] // size)
            out.append((size, at, at + n, found[1]))
            tree.insert(found[0] - n * size, found[1])
            at += n
    return out


def near_equal(runs: list[tuple[int, int]], shards: int) -> list[tuple[int, int, int, int]]:
    """Runs as by pack_runs: items above the mean of what is left are alone; the others are packed with
    the least capacity, within a thousandth of the mean, for which best-fit-decreasing needs no more than the shards left."""
    runs = sorted(runs, reverse=True)
    total, used, out = sum(s * n for s, n in runs), 0, []
    while runs and used < shards - 1 and runs[0][0] * (shards - used) > total:
        (size, count), first = runs[0], sum(e - f for s, f, e, _ in out if s == runs[0][0])
        out.append((size, first, first + 1, used))
        total, used = total - size, used + 1
        runs = ([(size, count - 1)] if count > 1 else []) + runs[1:]
    if not runs:
        return out
    begun = {runs[0][0]: sum(e - f for s, f, e, _ in out if s == runs[0][0])}
    left = shards - used
    low = -(-total // left)
    step = max(1, low // 1000)
    high, packed = low, pack_runs(runs, low, left)
    while packed is None:  # a step of twice the length each time, then halves of the last one
        low, high, step = high + 1, high + step, 2 * step
        packed = pack_runs(runs, high, left)
    while high - low > total // left // 1000:
        middle = (low + high) // 2
        found = pack_runs(runs, middle, left)
        if found is None:
            low = middle + 1
        else:
            high, packed = middle, found
    return out + [(s, begun.get(s, 0) + f, begun.get(s, 0) + e, used + b) for s, f, e, b in packed]


def _numbered(rows: DataFrame, group: list[str], number: str) -> DataFrame:
    """rows (with columns part, at) with a gapless number from 0 inside each group. A group is numbered part by part,
    so one that holds most rows isn't one task's."""
    before = Window.partitionBy(*group).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = rows.groupBy(*group, "part").count().select(*group, "part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("offset"))
    within = F.row_number().over(Window.partitionBy(*group, "part").orderBy("at")) - 1
    return rows.withColumn("within", within).join(offsets, [*group, "part"]).withColumn(number, (F.col("offset") + F.col("within")).cast("bigint")).drop("within", "offset")


def shard_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shards: int = 40) -> DataFrame:
    """One row a document: doc_id, size, text_crc32, law ('bytes'), shard, slot, grown_shard (null)."""
    spark = docs.sparkSession
    text = F.coalesce(docs[text_col], F.lit(""))
    rows = materialize(
        docs.select(
            docs[id_col].cast("bigint").alias("doc_id"),
            (F.octet_length(text).cast("bigint") + ROW_BYTES).alias("size"),
            F.crc32(text.cast("binary")).alias("text_crc32"),
            F.unhex(F.sha2(text, 256)).alias("key"),
            F.spark_partition_id().alias("part"),
            F.monotonically_increasing_id().alias("at"),
        ),
        "sized",
    )
    groups = materialize(
        rows.groupBy("key").agg(F.sum("size").alias("bytes")).select("key", "bytes", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("at")), "groups"
    )
    sizes = [(r.bytes, r.n) for r in groups.groupBy("bytes").agg(F.count(F.lit(1)).alias("n")).collect()]
    runs = spark.createDataFrame(near_equal(sizes, shards), "bytes bigint, first bigint, end bigint, shard int")
    ranked = _numbered(groups, ["bytes"], "rank")
    placed = materialize(ranked.join(runs, "bytes").filter("rank >= first and rank < end").select("key", "shard"), "placed")
    put = _numbered(rows.join(placed, "key").select("doc_id", "size", "text_crc32", "shard", "part", "at"), ["shard"], "slot")
    return put.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
