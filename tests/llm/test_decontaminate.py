import random

import duckdb
import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from galley.llm.decontaminate import GAP, MATCH, MISMATCH, align, contaminated

word = st.integers(2, 5)


def brute(a, b):
    h = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a, 1):
        for j, y in enumerate(b, 1):
            h[i][j] = max(0, h[i - 1][j - 1] + (MATCH if x == y else MISMATCH), h[i - 1][j] + GAP, h[i][j - 1] + GAP)
    return max(max(r) for r in h)


@given(st.lists(st.tuples(st.lists(word, min_size=1, max_size=12), st.lists(word, min_size=1, max_size=20)), min_size=1, max_size=6))
@settings(max_examples=100, deadline=None)
def test_smith_waterman(pairs):
    a, b = (np.array([x for p in pairs for x in p[k]], np.uint64) for k in (0, 1))
    ea, eb = (np.cumsum([len(p[k]) for p in pairs]) for k in (0, 1))
    score, first, last = align(a, ea - [len(p[0]) for p in pairs], ea, b, eb - [len(p[1]) for p in pairs], eb, cells=30)
    assert score.tolist() == [brute(*p) for p in pairs]
    for (x, y), s, f, t, off in zip(pairs, score, first, last, (eb - [len(p[1]) for p in pairs]).tolist(), strict=True):
        if s:
            assert brute(x, y[: t - off]) == s and brute(x, y[f - off :]) == s


def test_planted(spark):
    rng = random.Random(7)
    vocab = [f"w{i}" for i in range(4000)] + ["the", "of", "and"] * 400
    text = lambda n: [rng.choice(vocab) for _ in range(n)]
    items = [text(rng.randrange(15, 60)) for _ in range(30)] + [["the", "of", "and", "the", "of", "of"], ["a", "b"], []]
    rows, want = [], set()
    for d in range(300):
        w = text(rng.randrange(0, 400))
        if d % 3 == 0:
            k = rng.randrange(30)
            copy = [x if rng.random() > rng.choice([0, 0.1, 0.15]) else "new" for x in items[k]]
            if d % 2:
                del copy[len(copy) // 2]
            at = rng.randrange(len(w) + 1)
            w[at:at] = copy
            want.add((d, k))
        rows.append((d, " ".join(w).upper() if d % 5 == 0 else " ".join(w)))
    rows += [(900, None), (901, ""), (None, " ".join(items[0])), (902, "x " * 20_000 + " ".join(items[1])), (902, " ".join(items[1]))]
    want |= {(None, 0), (902, 1)}
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("item_id", F.lit("c"))
    bench = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(items)] + [(99, None)], "item_id bigint, text string").withColumn("doc_id", F.lit("c"))
    out = contaminated(docs, bench).collect()
    got = {(r.doc_id, r.item_id) for r in out}
    assert got - {x for x in got if x[1] == 30} == want
    words = {d: (t or "").split() for d, t in rows if d != 902}
    for r in out:
        if r.score == 1 and r.item_id < 30 and r.doc_id != 902:
            assert [w.lower() for w in words[r.doc_id][r.start_word : r.end_word]] == items[r.item_id]
    small = contaminated(docs, bench, block_words=100).collect()  # in blocks
    assert {(r.doc_id, r.item_id) for r in small if r.item_id != 30} == want
    assert contaminated(docs.filter("false"), bench).count() == 0 and contaminated(docs, bench.filter("false")).count() == 0


def test_documents_whole_copies(spark):
    p = "/root/testdata/sf0.01/"
    want = duckdb.sql(f"select d.doc_id, b.item_id from '{p}documents.parquet' d join '{p}benchmark.parquet' b on contains(regexp_replace(d.text, '\\s+', ' ', 'g'), regexp_replace(b.text, '\\s+', ' ', 'g'))").fetchall()
    out = contaminated(spark.read.parquet(p + "documents.parquet"), spark.read.parquet(p + "benchmark.parquet")).collect()
    assert set(want) <= {(r.doc_id, r.item_id) for r in out} and len(want) > 5


def test_hot_edited_leak(spark):
    rng = random.Random(3)
    items = [[f"leak{k}w{i}" for i in range(n)] for k, n in enumerate((20, 40))]
    rows, edited = [], {}
    for d in range(1800):
        w = [f"w{rng.randrange(3000)}" for _ in range(rng.randrange(10, 41))]
        if d % 3 < 2:  # each item in a third of all rows
            copy = [x if rng.random() > 0.15 else "new" for x in items[d % 3]]
            at = rng.randrange(len(w) + 1)
            w[at:at] = copy
            edited[d] = copy
        rows.append((d, " ".join(w)))
    whole = lambda c: any("new" not in c[i : i + 4] for i in range(len(c) - 3))
    want = {(d, d % 3) for d, c in edited.items() if brute(items[d % 3], c) >= len(c) and whole(c)}
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    bench = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(items)], "item_id bigint, text string")
    assert {(r.doc_id, r.item_id) for r in contaminated(docs, bench).collect()} == want and len(want) > 1000


def test_every_fourth_word_replaced(spark):
    rng = random.Random(5)
    vocab = [f"w{i}" for i in range(40000)]
    text = lambda n: [rng.choice(vocab) for _ in range(n)]
    items = [text(40) for _ in range(5)]
    rows = [(d, " ".join(text(60) + ["new" if i % 4 == 3 else x for i, x in enumerate(items[d % 5])] + text(60))) for d in range(20)]
    rows += [(d, " ".join(text(2000))) for d in range(20, 120)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    bench = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(items)] + [(9, "w1 w2 w3")], "item_id bigint, text string")
    assert sorted((r.doc_id, r.item_id) for r in contaminated(docs, bench).collect()) == [(d, d % 5) for d in range(20)]


def whole_query(rows, items, rare=1e-9, threshold=0.5):
    """The best local alignment of every document with every item, whatever the seeds."""
    words = lambda t: (t or "").lower().split()
    out = {}
    for d, t in rows:
        for k, i in items:
            a, b = words(i), words(t)
            if len(a) >= 4 and b:
                score = brute(a, b) / (MATCH * len(a))
                if score >= threshold:
                    out[d, k] = max(score, out.get((d, k), 0))
            elif a and (a == b):
                out[d, k] = 1.0
    return out


def test_query_is_brute_force(spark):
    """All pairs of texts and items with a score that counts, by plain Smith-Waterman. Texts hold one passage each, so the aligned
    passage is the best one."""
    rng = random.Random(21)
    vocab = [f"v{i}" for i in range(6000)]
    items = [(k, " ".join(rng.choice(vocab) for _ in range(rng.randrange(12, 40)))) for k in range(12)] + [(50, "Only three words"), (51, "one"), (52, ""), (53, None)]
    rows = []
    for d in range(160):
        w = [rng.choice(vocab) for _ in range(rng.randrange(0, 60))]
        if d % 2:
            part = items[d % 12][1].split()
            kind = d % 8
            if kind == 1:
                part = part[: max(4, len(part) * 3 // 4)]
            elif kind == 3:
                part = [x if rng.random() > 0.15 else "edit" for x in part]
            elif kind == 5:
                part = [x for x in part if rng.random() > 0.1]
            w[len(w) // 2 : len(w) // 2] = part
        rows.append((d, " ".join(w)))
    rows += [(500, "only THREE words"), (501, "one"), (502, "one more"), (503, None), (504, "")]
    got = contaminated(spark.createDataFrame(rows, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, text string")).collect()
    want = whole_query(rows, items)
    assert {(r.doc_id, r.item_id): round(r.score, 9) for r in got} == {k: round(v, 9) for k, v in want.items()}
    assert len(want) > 75 and (500, 50) in want and (501, 51) in want


def test_short_items_inside_a_text(spark):
    """Three rare words in a row are found; three frequent ones aren't."""
    rows = [(i, f"the cat sat here number{i} " + "plain words go on " * 400) for i in range(60)] + [(900, "zig zag zog " + "plain words go on " * 400)]
    items = [(1, "zig zag zog"), (2, "plain words go"), (3, "zag zog zig")]
    got = contaminated(spark.createDataFrame(rows, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, text string"), rare=1e-12).collect()
    assert {(r.doc_id, r.item_id) for r in got} <= {(900, 1)}
    got = contaminated(spark.createDataFrame(rows, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, text string"), rare=1e-11).collect()
    assert [(r.doc_id, r.item_id, r.score, r.start_word, r.end_word) for r in got] == [(900, 1, 1.0, 0, 3)]
