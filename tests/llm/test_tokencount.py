import re

import duckdb
import public_tokenizers
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from galley.llm.tokencount import section_tokens

WHOLE = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
WHOLE.encode_special_tokens = True


def brute(rows, rule, sections):
    out = []
    for d, t in rows:
        t = t or ""
        cuts = [0] + [m.end() for m in re.finditer("\n" if sections == "lines" else r"\n|(?<=[.!?]) ", t) if m.end() < len(t)] + [len(t)]
        at = [len(t[:i].encode()) for i in cuts]  # in bytes
        counts, crossing = [0] * (len(cuts) - 1), [0] * (len(cuts) - 1)
        raw = t.encode()
        pos = n = 0
        for tok in WHOLE.encode(t, add_special_tokens=False).tokens if t else []:
            size = len(tok)  # one character of the byte alphabet a byte
            share = [max(0, min(at[i + 1], pos + size) - max(at[i], pos)) for i in range(len(counts))]
            best = max(range(len(share)), key=lambda i: (share[i], -i)) if rule == "largest" else next(i for i, x in enumerate(share) if x)
            counts[best] += 1
            crossing[best] += sum(x > 0 for x in share) > 1
            pos += size
            n += 1
        assert pos == len(raw)
        out += [(d, i, cuts[i], cuts[i + 1], counts[i], crossing[i], n) for i in range(len(counts))]
    return sorted(out, key=str)


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_edges(spark):
    rows = [(1, None), (2, ""), (3, "\n"), (4, "a\n\n\n b. C d! é?  F.\n"), (5, "x" * 30_000 + ". y"), (None, "Hi. There"), (4, "Ends. "), (6, "<|endoftext|>. ñ 漢字. 🙂\n🙂")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("section", F.lit("c"))
    for rule in ("largest", "first"):
        for sections in ("lines", "sentences"):
            assert got(section_tokens(df, rule=rule, sections=sections)) == brute(rows, rule, sections)
    assert section_tokens(df.filter("false")).count() == 0


def test_documents(spark):
    p = "/root/testdata/sf0.001/documents.parquet"
    out = section_tokens(spark.read.parquet(p))
    assert got(out) == brute(duckdb.sql(f"select doc_id, text from '{p}'").fetchall(), "largest", "sentences")
    assert out.agg(F.sum("n_crossing")).first()[0] > 0
