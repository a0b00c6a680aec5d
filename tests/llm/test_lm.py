import math
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from galley.llm.elias_fano import BigramTrie, EliasFano, MappedTrie
from galley.llm.lm import STEP, coarse, dequantise, quantise, score_documents, spread, uncoarse

U = np.uint64


@given(st.lists(st.integers(0, 999), max_size=80), st.lists(st.integers(0, 999), min_size=1, max_size=40))
@settings(max_examples=100, deadline=None)
def test_elias_fano(values, queries):
    v = np.sort(np.array(values, U))
    ef = EliasFano(np.frombuffer(EliasFano.pack(v, 1000), np.uint8))
    assert ef.get(np.arange(len(v))).tolist() == v.tolist()
    i, equal = ef.successor(np.array(queries, U))
    assert i.tolist() == np.searchsorted(v, np.array(queries, U)).tolist()
    assert equal.tolist() == [q in values for q in queries]


def test_trie():
    rng = np.random.default_rng(0)
    pairs = sorted({(int(a), int(b)) for a, b in zip(rng.integers(0, 50, 900), rng.integers(0, 1 << 40, 900), strict=True)})
    a, b = (np.array(x, U) for x in zip(*pairs, strict=True))
    codes = rng.integers(1, 256, len(a)).astype(np.uint8)
    with MappedTrie(BigramTrie.pack(a, b, codes)) as trie:
        assert trie.lookup(a, b).tolist() == codes.tolist()
        assert not trie.lookup(a, b ^ U(1))[[(x, y ^ 1) not in set(pairs) for x, y in pairs]].any()
        assert not trie.lookup(a + U(100), b).any()
    with MappedTrie(BigramTrie.pack(a[:0], b[:0], codes[:0])) as trie:
        assert not trie.lookup(a, b).any()


def test_codes():
    p = 10.0 ** -np.linspace(0, 7, 500)
    q = dequantise(quantise(p))
    assert (q <= p * (1 + 1e-9)).all() and (q >= p * 10**-STEP * 0.999).all()


def test_sums_to_at_most_one():
    """Whatever follows a context, with the rounding of both kinds."""
    rng = np.random.default_rng(2)
    count = rng.integers(0, 500, 400)
    unigram = (count + 0.5) / (count.sum() + 0.5 * ((count > 0).sum() + 1))
    rough = uncoarse(coarse(count)) / (count.sum() + 0.5 * ((count > 0).sum() + 1))
    assert (rough <= unigram * (1 + 1e-9)).all()
    for c1 in (1, 7, 4000):
        pairs = np.bincount(rng.choice(400, c1), minlength=400)
        m = spread(c1)
        code = np.where(pairs > 0, quantise((pairs + m * rough) / (c1 + m)), 0)
        p = np.where(code > 0, dequantise(code), m * unigram / (c1 + m))
        assert 0.85 < p.sum() <= 1 + 1e-9


def words(t):
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))


def brute(rows):
    """The whole model by plain counting."""
    held = {d: zlib.crc32(("" if d is None else str(d)).encode()) % 5 == 1 for d, _ in rows}
    uni, bi = Counter(), Counter()
    for d, t in rows:
        if not held[d]:
            w = ["</s>", *words(t), "</s>"]
            uni.update(w[1:])
            bi.update(zip(w, w[1:]))
    n, v = sum(uni.values()), len(uni)
    pu = lambda w: (uni[w] + 0.5) / (n + 0.5 * (v + 1))
    out = []
    for d, t in rows:
        w = ["</s>", *words(t), "</s>"]
        base = score = 0.0
        for a, b in zip(w, w[1:]):
            base += math.log10(pu(b))
            m = 2 * uni[a] ** 0.8
            code = 0
            if bi[a, b]:
                rough = float(uncoarse(coarse(np.array([uni[b]])))[0]) / (n + 0.5 * (v + 1))
                code = int(quantise(np.array([(bi[a, b] + m * rough) / (uni[a] + m)]))[0])
            score += math.log10(float(dequantise(np.array([code]))[0]) if code else (m / (uni[a] + m) if uni[a] else 1) * pu(b))
        out.append((d, held[d], len(w) - 1, sum(uni[x] > 0 for x in w[1:]), n, round(base, 6), round(score, 6)))
    return sorted(out, key=str)


def got(df):
    return sorted(((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6), round(r.score, 6)) for r in df.collect()), key=str)


def test_edges(spark):
    rows = [(i, f"the Cat sat on the mat {i % 3} x{i}") for i in range(30)] + [(100, None), (101, ""), (102, "é " * 50), (None, "the cat"), (1, "again again"), (103, "unseen words only"), (2**63 - 1, "the end")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("score", F.lit("c"))
    assert got(score_documents(df)) == brute(rows)
    assert score_documents(df.filter("false")).count() == 0


def test_documents(spark):
    p = "/root/testdata/sf0.001/documents.parquet"
    rows = duckdb.sql(f"select doc_id, text from '{p}'").fetchall()
    out = got(score_documents(spark.read.parquet(p)))
    assert out == brute(rows)
    held = [r for r in out if r[1]]
    assert sum(r[6] for r in held) > sum(r[5] for r in held)
