"""The pipeline's stages against brute force, each on what its predecessor kept."""

import random

import corpus_pipeline as P
from galley.llm.toxicity import fit_chain, score_toxicity
from test_exact import low
from test_near import brute as near_classes
from test_packing import check as check_packing

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def write(spark, path, rows, labels, items):
    spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint").repartition(3).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame(items, "item_id bigint, text string").write.parquet(f"{path}/benchmark.parquet")


def test_stages(spark, tmp_path):
    rng = random.Random(4)
    vocab = [f"w{i}" for i in range(2500)]
    text = lambda n: " ".join(rng.choice(vocab) for _ in range(n))
    items = [text(40) for _ in range(4)]
    rows, labels = [], []
    for d in range(260):
        t = text(rng.randrange(30, 120))
        if d % 9 == 0:
            t += " idiot scum"
        if d % 11 == 0:
            t += " " + items[d % 4]
        if d % 13 == 0 and d:
            t = rows[d - 1][1]  # an exact copy
        if d % 17 == 0 and d:
            t = rows[d - 2][1] + " tail"  # a near copy
        rows.append((d, t, "en", "s", len(t)))
        labels.append((d, int(d % 9 != 0), int("idiot" in t)))
    rows += [(900, None, None, None, None), (901, "", "en", "s", 0), (902, "", "en", "s", 0), (None, "no id here at all", "en", "s", 3), (5, rows[5][1], "en", "s", 1)]
    write(spark, str(tmp_path), rows, labels, list(enumerate(items)))
    docs, kept = spark.read.parquet(f"{tmp_path}/documents.parquet"), {}
    for k, (name, stage) in enumerate(P.STAGES):
        out = stage(spark, docs, str(tmp_path))
        if k < 4:
            assert out.columns == COLUMNS
        out.write.parquet(f"{tmp_path}/out{k}")
        before, docs = docs, spark.read.parquet(f"{tmp_path}/out{k}")
        key = lambda df: sorted(((r.doc_id, r.text) for r in df.select("doc_id", "text").collect()), key=str)
        was, kept[name] = key(before), key(docs) if k < 4 else None
        if name == "toxicity":
            scored = score_toxicity(before, fit_chain(before, spark.read.parquet(f"{tmp_path}/labels.parquet"), P.CATEGORIES), P.CATEGORIES)
            good = sorted((r.doc_id for r in scored.filter("not rejected").collect()), key=str)
            assert [d for d, _ in kept[name]] == good and not any("idiot" in (t or "") for _, t in kept[name])
            assert len(kept[name]) > 200
        elif name == "exact_dedup":
            best: dict = {}
            for d, t in was:
                best[low(t)] = max(best.get(low(t), -1), -1 if d is None else d)
            assert sorted((low(t), -1 if d is None else d) for d, t in kept[name]) == sorted(best.items())
        elif name == "near_dedup":
            groups = near_classes([(i, t) for i, (_, t) in enumerate(was)])
            assert len(kept[name]) == len(groups) and {was.index(x) for x in kept[name]} <= set(range(len(was)))
            assert all(sum(was[i] in kept[name] for i in g) == 1 for g in groups)
        elif name == "decontamination":
            leaks = {d for d, t in was if any(i in (t or "") for i in items)}
            assert leaks and {d for d, _ in was} - {d for d, _ in kept[name]} == leaks
        else:
            check_packing(was, docs.collect())


def test_run_is_the_stages(spark, tmp_path):
    rows = [(i, f"some words number {i} " * 9, "en", "s", 1) for i in range(30)]
    write(spark, str(tmp_path), rows, [(0, 1, 0)], [])
    assert {r.doc_id for r in P.run(spark, str(tmp_path)).collect()} == set(range(30))
    write(spark, str(tmp_path / "none"), [], [], [(1, "a b c d e")])
    assert P.run(spark, str(tmp_path / "none")).count() == 0
