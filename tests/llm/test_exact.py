import hashlib
from collections import defaultdict

import duckdb
from pyspark.sql import functions as F

from galley.llm.exact import exact_dedup
from galley.llm.queries import OP1_SQL


def low(t):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")


def test_edges(spark):
    rows = [(1, "Ab"), (2, "aB"), (3, None), (4, ""), (5, "É"), (6, "é"), (7, "x" * 100_000), (8, "X" * 100_000), (None, "ab"), (None, "q"), (9, "dup"), (9, "dup"), (10, " ab")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("fp", F.lit(1)).withColumn("id", F.lit("c")).repartition(3)
    out = exact_dedup(df).collect()
    groups = defaultdict(list)
    for d, t in rows:
        groups[low(t)].append(d)
    by_sha = {hashlib.sha256(k.encode()).hexdigest(): v for k, v in groups.items()}
    assert len(out) == len(rows)
    kept = defaultdict(int)
    for r in out:
        ids = by_sha[r.text_sha256]
        best = max((d for d in ids if d is not None), default=None)
        assert (r.group_size, r.keep_id) == (len(ids), best)
        assert not r.kept or r.doc_id == best
        kept[r.text_sha256] += r.kept
    assert set(kept.values()) == {1} and len(kept) == len(groups)
    assert exact_dedup(df.filter("false")).count() == 0


def test_documents(spark):
    p = "/root/testdata/sf0.001/documents.parquet"
    duckdb.sql(f"create or replace view documents as select * from '{p}'")
    want = sorted(duckdb.sql(OP1_SQL).fetchall())
    got = sorted(tuple(r) for r in exact_dedup(spark.read.parquet(p)).select("doc_id", "group_size", "keep_id", "kept", "text_sha256").collect())
    cols = [c.lower() for c in duckdb.sql(OP1_SQL).columns]
    order = [cols.index(c) for c in ("doc_id", "group_size", "keep_id", "kept", "text_sha256")]
    assert got == [tuple(r[i] for i in order) for r in want]
