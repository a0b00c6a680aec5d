import random

import numpy as np
from pyspark.sql import functions as F

from galley.llm.toxicity import Chain, fit_chain, logistic, score_toxicity


def test_logistic():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(4000, 3))
    w = np.array([1.5, -2.0, 0.0])
    y = (rng.random(4000) < 1 / (1 + np.exp(-(x @ w + 0.5)))).astype(float)
    assert np.abs(logistic(x, y) - [*w, 0.5]).max() < 0.25


def test_chain_uses_earlier_categories():
    rng = np.random.default_rng(1)
    n = 600
    first = rng.random(n) < 0.5
    doc, feature = np.flatnonzero(first), np.ones(first.sum(), np.int64)
    chain = Chain.fit(doc, feature, np.column_stack([first, first]).astype(float), np.arange(n) % 5)
    assert chain.links[1].chain.shape == (1,) and chain.links[0].chain.shape == (0,)
    p = chain.probabilities(doc, feature, n)
    assert ((p[:, 1] > 0.5) == first).mean() > 0.99


def test_edges(spark):
    rng = random.Random(2)
    vocab = [f"w{i}" for i in range(300)]
    rows, labels = [], []
    for d in range(400):
        toxic = d % 8 == 0
        w = [rng.choice(vocab) for _ in range(rng.randrange(5, 60))]
        if toxic:
            w.insert(rng.randrange(len(w)), rng.choice(["idiot", "Scum,", "grauslich" + str(d)]))
        rows.append((d, " ".join(w)))
        if d % 2 == 0:
            labels.append((d, 1 - toxic, int(toxic)))
    rows += [(1000, None), (1001, ""), (None, "scum, idiot"), (0, rows[0][1]), (1002, "y " * 50_000)]
    labels += [(5000, 1, 1), (None, 0, 1), (6, None, None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("id", F.lit("c")).withColumn("toxic", F.lit("c"))
    table = spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").withColumn("text", F.lit("c"))
    chain = fit_chain(docs, table, ("quality", "toxic"))
    out = score_toxicity(docs, chain, ("quality", "toxic")).collect()
    assert len(out) == len(rows)
    unseen = [r for r in out if r.doc_id is not None and r.doc_id < 400 and r.doc_id % 2]
    assert not any(r.rejected for r in unseen)
    toxic = [r for r in out if r.doc_id is not None and r.doc_id < 400 and r.doc_id % 8 == 0]
    assert sum(r.rejected for r in toxic) >= 0.9 * len(toxic)
    assert [r.rejected for r in out if r.doc_id in (None, 1000, 1001, 1002)].count(True) == 1
    # no labels at all, no documents
    blank = fit_chain(docs, table.filter("false"), ("quality", "toxic"))
    assert {r.p_toxic for r in score_toxicity(docs, blank, ("quality", "toxic")).collect()} == {0.5}
    assert score_toxicity(docs.filter("false"), chain, ("quality", "toxic")).count() == 0


def test_held_out_accuracy(spark):
    p = "/root/testdata/sf0.1/"
    docs, labels = spark.read.parquet(p + "documents.parquet"), spark.read.parquet(p + "labels.parquet")
    chain = fit_chain(docs, labels.filter("doc_id % 3 <> 0"), ("quality", "toxic"))
    r = score_toxicity(docs, chain, ("quality", "toxic")).join(labels.filter("doc_id % 3 = 0"), "doc_id").groupBy("toxic").agg(F.avg(F.col("rejected").cast("int")).alias("share"), F.count("*").alias("n")).collect()
    share = {x.toxic: x.share for x in r}
    assert share[1] > 0.85 and share[0] < 0.01
