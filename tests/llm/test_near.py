import math
import random
import re
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from galley.llm.components import connected_components
from galley.llm.near import IDF_SHARE, common_weights, near_dedup, shared_weight, signatures


def brute(rows, t=0.8, n=5):
    """Classes by comparing all pairs that share a shingle."""
    words = [re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), x or "")) for _, x in rows]
    bags = [Counter(tuple(w[i : i + n]) for i in range(len(w) - n + 1)) for w in words]
    df = Counter(s for b in {tuple(w): b for w, b in zip(words, bags, strict=True)}.values() for s in b)
    size = len(rows)
    w = {s: 1 + IDF_SHARE * math.log(max(1, size / c)) / math.log(max(2, size)) for s, c in df.items()}
    total = [sum(c * w[s] for s, c in b.items()) for b in bags]
    parent = list(range(size))

    def find(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    post, near = defaultdict(list), []
    for i, b in enumerate(bags):
        for s in b:
            post[s].append(i)
    seen = set()
    for p in post.values():
        for x in range(len(p)):
            for y in range(x):
                if (p[y], p[x]) not in seen:
                    seen.add((p[y], p[x]))
                    i, j = p[y], p[x]
                    common = sum(min(c, bags[j][s]) * w[s] for s, c in bags[i].items() if s in bags[j])
                    sim = common / (total[i] + total[j] - common)
                    if sim >= t:
                        parent[find(i)] = find(j)
                    elif sim > t - 0.02:
                        near.append((i, j))
    same = {}
    for i, x in enumerate(words):
        k = tuple(x)
        parent[find(i)] = find(same.setdefault(k, i))
    groups = defaultdict(list)
    for i in range(size):
        groups[find(i)].append(rows[i][0])
    return sorted((sorted(g, key=str) for g in groups.values()), key=str)


def classes(out):
    groups = defaultdict(list)
    kept = Counter()
    for r in out:
        groups[r.class_id, r.class_size].append(r.doc_id)
        kept[r.class_id] += r.kept
    for (c, n), g in groups.items():
        if c is not None:
            assert c == min(d for d in g if d is not None) and len(g) == n and kept[c] == 1
    return sorted((sorted(g, key=str) for g in groups.values()), key=str)


def edited(rng, words, share):
    return [f"e{rng.random()}" if rng.random() < share else w for w in words]


def test_groups(spark):
    rng = random.Random(3)
    vocab = [f"w{i}" for i in range(3000)]
    rows, common = [], [rng.choice(vocab) for _ in range(60)]
    for g in range(12):
        base = [rng.choice(vocab) for _ in range(rng.randrange(60, 300))]
        for _ in range(rng.randrange(1, 14)):
            rows.append((len(rows), " ".join(edited(rng, base, rng.choice([0, 0.005, 0.01, 0.03])))))
    for _ in range(40):  # a passage that many share makes no near copies
        own = [rng.choice(vocab) for _ in range(70)]
        rows.append((len(rows), " ".join(own + common)))
    chain = [rng.choice(vocab) for _ in range(200)]
    for _ in range(12):
        chain = chain[6:] + [rng.choice(vocab) for _ in range(6)]
        rows.append((len(rows), " ".join(chain)))
    rows += [(len(rows), "x " * 400), (len(rows) + 1, "X " * 420), (len(rows) + 2, "a b"), (len(rows) + 3, "A  b"), (len(rows) + 4, None), (len(rows) + 5, ""), (None, "only null"), (3, rows[3][1])]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("node", F.lit("c")).withColumn("d", F.lit(1))
    assert classes(near_dedup(df).collect()) == brute(rows)
    assert near_dedup(df.filter("false")).count() == 0


def test_large_group(spark, monkeypatch):
    """Over 1,000 copies of one text with J from 0.2 to 1 to it, and texts that share half of it; blocks are small, so that a bucket has many."""
    from galley.llm import near

    monkeypatch.setattr(near, "BLOCK", 64)
    rng = random.Random(11)
    vocab = [f"w{i}" for i in range(4000)]
    base = [rng.choice(vocab) for _ in range(150)]
    rows = []
    for i in range(1100):
        share = rng.choice([0.001, 0.004, 0.006, 0.01, 0.02, 0.04, 0.1])
        text = edited(rng, base, share)
        if i % 5 == 0:  # edits that several copies share: links that don't go through the base
            text[i % 3 * 40 : i % 3 * 40 + 12] = [f"s{i % 15}{k}" for k in range(12)]
        rows.append((i, " ".join(text)))
    rows += [(2000 + i, " ".join(base[:75] + [rng.choice(vocab) for _ in range(75)])) for i in range(50)]
    got = classes(near_dedup(spark.createDataFrame(rows, "doc_id bigint, text string")).collect())
    assert got == brute(rows)
    assert 500 < max(map(len, got)) < 1100


def test_chunks_of_very_many_documents():
    """Keys and documents that don't fit into 64 bits together are sorted by both."""
    from types import SimpleNamespace

    import pyarrow as pa

    from galley.llm.near import shingle_pairs
    from galley.llm.substring import _in_documents
    from galley.llm.words import Words

    texts = [f"a b c d e f w{i % 7}" for i in range(70_000)]
    words = Words.of(pa.array(texts))
    key, doc, tf = shingle_pairs(SimpleNamespace(ids=np.arange(len(texts))), words, 5)
    assert len(key) == 3 * len(texts) and (tf == 1).all() and (np.lexsort((doc, key)) == np.arange(len(key))).all()
    few = Words.of(pa.array(texts[:50]))
    small = shingle_pairs(SimpleNamespace(ids=np.arange(50)), few, 5)
    assert sorted(zip(key[doc < 50].tolist(), doc[doc < 50].tolist())) == list(zip(small[0].tolist(), small[1].tolist()))
    rng = np.random.default_rng(3)
    k, d = rng.integers(0, 500, 4000).astype(np.uint64), np.sort(rng.integers(0, 900, 4000))
    a, b = _in_documents(k, d, 900), _in_documents(k, d, 1 << 20)
    assert a[0].tolist() == b[0].tolist() == sorted(set(k.tolist())) and a[1].tolist() == b[1].tolist()
    assert a[1].tolist() == [min(2, len({y for x, y in zip(k.tolist(), d.tolist()) if x == v})) for v in a[0].tolist()]


def test_common_weights():
    rng = np.random.default_rng(4)
    vectors = []
    for _ in range(30):
        keys = np.sort(rng.choice(6000, 900, replace=False)).astype(np.uint64)
        vectors.append((keys, rng.integers(1, 4, len(keys)), 1 + keys.astype(np.int64) % 50))
    a, b = np.arange(10), np.arange(5, 30)
    got = common_weights(vectors, a, b, 1000)
    want = [[shared_weight(vectors[i], vectors[j], 1000) for j in b] for i in a]
    assert np.allclose(got, want, rtol=1e-5)


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_documents(spark, sf):
    p = f"/root/testdata/{sf}/documents.parquet"
    assert classes(near_dedup(spark.read.parquet(p)).collect()) == brute(duckdb.sql(f"select doc_id, text from '{p}'").fetchall())


def test_samples_match_weighted_jaccard():
    rng = np.random.default_rng(1)
    keys = np.arange(1, 41, dtype=np.uint64) * np.uint64(7919)
    w = rng.uniform(0.5, 3, 40)
    v = w * rng.choice([1, 1, 0.5, 2], 40)
    sig = signatures(np.concatenate([keys, keys]), np.concatenate([w, v]), np.repeat([0, 1], 40), np.array([4.0, 9.0]), np.array([11, 12], np.uint64), 4000)
    want = np.minimum(w, v).sum() / (np.maximum(w, v).sum() + 13)
    assert abs((sig[0] == sig[1]).mean() - want) < 0.03


def test_components(spark):
    rng = random.Random(5)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(400 + i, 401 + i) for i in range(60)] + [(900, 900)]
    parent = {}
    find = lambda x: x if parent.setdefault(x, x) == x else find(parent[x])
    for a, b in edges:
        if a != b:
            x, y = find(a), find(b)
            parent[max(x, y)] = min(x, y)
    got = dict(connected_components(spark.createDataFrame(edges, "a int, b int"), "a", "b").collect())
    assert got == {x: find(x) for x in parent}
