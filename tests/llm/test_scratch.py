import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from galley.llm.quotient import CountingQuotientFilter as CQF
from galley.llm.scratch import materialize, shared_dir
from galley.llm.words import Words, windows


@given(st.lists(st.integers(0, 2**40), max_size=60), st.lists(st.integers(0, 2**40), max_size=60), st.integers(0, 5))
@settings(max_examples=80, deadline=None)
def test_filters_merge_losslessly(a, b, bits):
    f, g = (CQF.build(np.array(x, np.uint64), 41) for x in (a, b))
    parts = [CQF.merge([CQF.from_bytes(x.to_bytes()), CQF.from_bytes(y.to_bytes())]) for x, y in zip(f.split(bits), g.split(bits), strict=True)]
    got = {(k << (41 - bits)) | int(key): int(n) for k, p in enumerate(parts) for key, n in zip(p.keys, p.counts, strict=True)}
    assert got == {x: (a + b).count(x) for x in a + b}
    assert [t.tolist() for t in CQF.totals([f, g])] == [[(a + b).count(int(k)) for k in x.keys] for x in (f, g)]


@given(st.lists(st.text(alphabet="ab \t\né", max_size=30) | st.none(), max_size=8), st.integers(1, 5))
@settings(max_examples=100, deadline=None)
def test_words_and_windows(texts, n):
    import re

    w = Words.of(pa.array(texts, pa.string()))
    want = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for t in texts]
    got = [[w.data[w.starts[i] : w.ends[i]].tobytes().decode() for i in range(a, b)] for a, b in zip(w.first[:-1], w.first[1:], strict=True)]
    assert got == want
    h, at = windows(w.hashes, w.first, n)
    assert at.tolist() == [int(w.first[d]) + i for d, x in enumerate(want) for i in range(len(x) - n + 1)]
    flat = [tuple(x[i : i + n]) for x in want for i in range(len(x) - n + 1)]
    same = {}
    for k, v in zip(flat, h.tolist(), strict=True):
        assert same.setdefault(k, v) == v
    assert len(set(same.values())) == len(same)


def test_long_words_span_blocks():
    import galley.llm.words as W

    text = "x" * (W.BLOCK + 10) + " " + "y" * (3 * W.BLOCK) + " z"
    w = Words.of(pa.array([text, "z"]))
    assert w.counts.tolist() == [3, 1] and w.hashes[2] == w.hashes[3]


def test_materialize(spark):
    df = spark.range(10).toDF("a")
    out = materialize(df, "x")
    assert out.count() == 10 and shared_dir(spark).removeprefix("file:").strip("/") in out.inputFiles()[0]
