import zlib
from collections import defaultdict

import duckdb
import numpy as np
import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from galley.llm.packing import cuts, encoder, pack_documents
from galley.llm.words import Words

PATH = public_tokenizers.path("word_bpe_49k.json")
WHOLE = Tokenizer.from_file(PATH)


@given(st.lists(st.text(alphabet=st.one_of(st.characters(exclude_categories=["Cs"]), st.sampled_from(" \t\n\x0b\x1c\x85  'sİßΣς́éÀ<|endoftext|>"))), max_size=5))
@settings(max_examples=150, deadline=None)
def test_ids_are_the_tokenizers(texts):
    import pyarrow as pa

    words = Words.of(pa.array(texts, pa.string()))
    ids, size = encoder(PATH).encode(words)
    at = np.concatenate([[0], np.cumsum(size)])[words.first]
    for i, t in enumerate(texts):
        assert ids[at[i] : at[i + 1]].tolist() == WHOLE.encode(t, add_special_tokens=False).ids


def test_cuts():
    totals = np.array([1, 5, 4096, 8192 + 7, 12, 4095])
    doc, start, length = cuts(totals, 4096)
    for i, n in enumerate(totals):
        s, ln = start[doc == i], length[doc == i]
        assert s[0] == 0 and (s[1:] == (s + ln)[:-1]).all() and (s + ln)[-1] == n and (ln & (ln - 1) == 0).all() and ln.max() <= 4096


def check(rows, out):
    pieces = defaultdict(list)
    for r in out:
        pieces[r.doc_id].append(r)
        assert r.offset == 0 and r.length & (r.length - 1) == 0 and r.length <= 4096 and r.length == 1 << r.bucket
    assert len({r.sequence_id for r in out}) == len(out)
    for d, t in rows:
        ids = np.array([*WHOLE.encode(t or "", add_special_tokens=False).ids, 2], "<u4")
        at = 0
        for r in sorted(pieces[d], key=lambda r: r.start):
            assert r.start == at and r.doc_tokens == len(ids)
            assert r.ids_crc32 == zlib.crc32(ids[at : at + r.length].tobytes())
            at += r.length
        assert at == len(ids)


def test_edges(spark):
    rows = [(1, None), (2, ""), (3, "Hello, WORLD's <|endoftext|> x" * 3), (4, "né " * 9000), (None, "a"), (5, "\x85a b  c")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("length", F.lit("c"))
    check(rows, pack_documents(df).collect())
    assert pack_documents(df.filter("false")).count() == 0


def test_documents(spark):
    p = "/root/testdata/sf0.001/documents.parquet"
    check(duckdb.sql(f"select doc_id, text from '{p}'").fetchall(), pack_documents(spark.read.parquet(p)).collect())
