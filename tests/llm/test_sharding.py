import random
import zlib
from collections import Counter, defaultdict

import duckdb
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from galley.llm.sharding import CapacityTree, best_fit_decreasing, near_equal, pack_runs, shard_documents


@given(st.lists(st.integers(1, 60), max_size=60), st.integers(60, 100))
@settings(max_examples=60, deadline=None)
def test_best_fit_is_tightest(sizes, capacity):
    bins: list[int] = []
    want = [0] * len(sizes)
    for i in sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)):
        fits = [(r, b) for b, r in enumerate(bins) if r >= sizes[i]]
        if not fits:
            bins.append(capacity)
            fits = [(capacity, len(bins) - 1)]
        b = min(fits)[1]
        want[i] = b
        bins[b] -= sizes[i]
    assert best_fit_decreasing(sizes, capacity) == want


def test_tree():
    rng = random.Random(1)
    tree, held = CapacityTree(), set()
    for k in range(500):
        x = (rng.randrange(100), k)
        tree.insert(*x)
        held.add(x)
        size = rng.randrange(110)
        want = min((y for y in held if y[0] >= size), default=None)
        assert tree.take_tightest(size) == want
        held.discard(want)


def loads(runs):
    load = defaultdict(int)
    for size, first, end, b in runs:
        load[b] += size * (end - first)
    return load


@given(st.lists(st.integers(1, 30), max_size=80), st.integers(30, 90))
@settings(max_examples=100, deadline=None)
def test_runs_are_best_fit_decreasing(sizes, capacity):
    bins = best_fit_decreasing(sizes, capacity)
    want = defaultdict(Counter)
    for s, b in zip(sizes, bins, strict=True):
        want[b][s] += 1
    runs = sorted(Counter(sizes).items(), reverse=True)
    need = max(bins, default=-1) + 1
    got = defaultdict(Counter)
    for size, first, end, b in pack_runs(runs, capacity, need):
        got[b][size] += end - first
    assert got == want
    if need:
        assert pack_runs(runs, capacity, need - 1) is None


@given(st.lists(st.integers(1, 400), max_size=60), st.integers(1, 9))
@settings(max_examples=100, deadline=None)
def test_near_equal(sizes, shards):
    out = near_equal(list(Counter(sizes).items()), shards)
    for size, n in Counter(sizes).items():  # every item of a size lies in one run
        assert sorted(x for s, f, e, _ in out if s == size for x in range(f, e)) == list(range(n))
    load = loads(out)
    assert all(0 <= b < shards for b in load)
    assert max(load.values(), default=0) <= max(max(sizes, default=0), 1.5 * sum(sizes) / shards + max(sizes, default=0))


def test_heavy_items_are_alone():
    load = loads(near_equal([(1000, 1), (10, 390)], 40))
    assert len(load) == 40 and sorted(load.values())[:-1] == [100] * 39
    load = loads(near_equal([(1000, 3), (10, 10)], 5))
    assert sorted(load.values()) == [50, 50, 1000, 1000, 1000]


def check(rows, out, shards):
    assert len(out) == len(rows)
    where, slots = {}, defaultdict(list)
    for r in out:
        slots[r.shard].append(r.slot)
        assert 0 <= r.shard < shards and r.law == "bytes" and r.grown_shard is None
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())
    text = defaultdict(set)
    for d, t in rows:
        text[zlib.crc32((t or "").encode()), len((t or "").encode()) + 16].add(d)
    for r in out:
        assert r.doc_id in text[r.text_crc32, r.size]
        assert where.setdefault((r.text_crc32, r.size), r.shard) == r.shard


def test_edges(spark):
    rows = [(1, None), (2, ""), (3, "é" * 50_000), (None, "x"), (4, "x"), (4, "x"), (5, "y z")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("key", F.lit(1)).withColumn("shard", F.lit("c"))
    check(rows, shard_documents(df).collect(), 40)
    check(rows, shard_documents(df, shards=1).collect(), 1)
    assert shard_documents(df.filter("false")).count() == 0


def test_query_is_best_fit_decreasing(spark):
    """Against a plain best-fit-decreasing over all groups, one by one, with one more byte of capacity until the shards do."""
    rng = random.Random(8)
    rows = [(i, "x" * rng.randrange(1, 60) + str(rng.randrange(40))) for i in range(900)] + [(i, "hot") for i in range(900, 1500)]
    out = shard_documents(spark.createDataFrame(rows, "doc_id bigint, text string"), shards=7).collect()
    check(rows, out, 7)
    group = Counter()
    for _, t in rows:
        group[t] += len(t) + 16
    load = Counter()
    for r in out:
        load[r.shard] += r.size
    rest = sorted(group.values())[:-1]
    assert load[0] == group["hot"]
    capacity = -(-sum(rest) // 6)
    while max(best_fit_decreasing(rest, capacity)) > 5:
        capacity += 1
    assert max(load[k] for k in range(1, 7)) <= capacity + sum(rest) / 6000 + 1


def test_documents(spark):
    p = "/root/testdata/sf0.01/documents.parquet"
    rows = duckdb.sql(f"select doc_id, text from '{p}'").fetchall()
    out = shard_documents(spark.read.parquet(p)).collect()
    check(rows, out, 40)
    load = defaultdict(int)
    for r in out:
        load[r.shard] += r.size
    assert len(load) == 40 and max(load.values()) < 1.01 * sum(load.values()) / 40
