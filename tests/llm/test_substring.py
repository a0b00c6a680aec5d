import hashlib
import re

import duckdb
from pyspark.sql import functions as F

from galley.llm.substring import substring_dedup


def brute(rows, n=13):
    first = {}
    words = [(d, re.findall(r"[^\x20\x09-\x0D]+", t or "")) for d, t in rows]
    for d, w in words:
        for i in range(len(w) - n + 1):
            k = tuple(w[i : i + n])
            first[k] = min(first.get(k, 1 << 64), 1 << 64 if d is None else d)
    out = []
    for d, w in words:
        dead = set()
        for i in range(len(w) - n + 1):
            if first[tuple(w[i : i + n])] < (1 << 64 if d is None else d):
                dead.update(range(i, i + n))
        kept = [x for i, x in enumerate(w) if i not in dead]
        out.append((d, len(w), len(dead), hashlib.sha256(" ".join(kept).encode()).hexdigest()))
    return sorted(out, key=str)


def longest(rows, n):
    """By every length in turn: the longest at which a row has a window that another row has."""
    words = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for _, t in rows]
    out, size = [0] * len(rows), n
    while True:
        where = {}
        for k, w in enumerate(words):
            for i in range(len(w) - size + 1):
                where.setdefault(tuple(w[i : i + size]), set()).add(k)
        again = {k for v in where.values() if len(v) > 1 for k in v}
        if not again:
            return sorted(zip((d for d, _ in rows), out), key=str)
        for k in again:
            out[k] = size
        size *= 2


def test_longest(spark):
    rng = __import__("random").Random(2)
    word = lambda n: [f"v{rng.randrange(5000)}" for _ in range(n)]
    shared = [word(n) for n in (13, 25, 26, 60, 104, 300)]
    rows = [(i, " ".join(word(rng.randrange(30)) + shared[i % 6] + word(rng.randrange(30)))) for i in range(60)]
    rows += [(100, "a b " * 300), (101, "a b " * 90), (102, " ".join(shared[5][:52] + word(1) + shared[5][53:])), (103, None), (103, "few words")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert sorted(((r.doc_id, r.longest) for r in substring_dedup(df).collect()), key=str) == longest(rows, 13)
    assert sorted(((r.doc_id, r.longest) for r in substring_dedup(df, min_words=5).collect()), key=str) == longest(rows, 5)


def got(df):
    return sorted(((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in df.collect()), key=str)


def test_edges(spark):
    a = " ".join(f"w{i}" for i in range(40))
    rows = [(5, a), (3, a + "  tail\tx"), (9, "w3 " + a[:60]), (1, None), (2, ""), (4, " \n "), (None, a), (None, a), (7, "é ü " * 20), (8, "x " * 14), (6, a.upper()), (5, a), (10, "x " * 30), (2**63 - 1, a + " z"), (-(2**63), "n " * 20), (2**63 - 1, a)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("extra", F.lit(1)).withColumn("chunk", F.lit("c"))
    res = substring_dedup(df)
    assert got(res) == brute(rows)
    assert all(hashlib.sha256(r.kept_text.encode()).hexdigest() == r.kept_sha256 for r in res.collect())
    assert got(substring_dedup(df, min_words=3)) == brute(rows, 3)
    assert substring_dedup(df.filter("false")).count() == 0


def test_one_id_for_all(spark):
    """No id gathers in one chunk."""
    from galley.llm import chunks as C

    df = spark.range(20000).select(F.lit(None).cast("bigint").alias("doc_id"), F.lit("a b c").alias("text"))
    n = C.store(df, "doc_id", "text", 16).select("chunk", (F.length("nulls")).alias("n")).groupBy("chunk").sum("n").collect()
    assert len(n) == 16 and max(r[1] for r in n) < 2000
    assert {(r.doc_id, r.n_words, r.n_removed) for r in substring_dedup(df).collect()} == {(None, 3, 0)}


def test_documents(spark):
    p = "/root/testdata/sf0.001/documents.parquet"
    rows = duckdb.sql(f"select doc_id, text from '{p}'").fetchall()
    out = substring_dedup(spark.read.parquet(p), with_text=False)
    assert got(out) == brute(rows)
    assert sorted(((r.doc_id, r.longest) for r in out.collect()), key=str) == longest(rows, 13)
