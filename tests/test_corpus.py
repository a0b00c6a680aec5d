import json

import pytest
from pyspark.sql import functions as F

from galley import schemas as S
from galley.operators import rollup
from galley.sources import catalog, corpus, sinks, state
from galley.streaming import corpus as live


def papers(spark, rows):
    """rows: (arxiv_id, archive, category, year, status, reason)."""
    full = [dict(zip(("arxiv_id", "archive", "primary_category", "year", "status", "reason"), r, strict=True)) | {"pages_total": 10, "pages_with_labels": 4, "labels_total": 7, "labels_by_kind": {"figure": 5, "table": 1}, "box_counts_histogram": {"0": 6}, "spatial_pair_ok": {}} for r in rows]
    return spark.createDataFrame(full, S.PAPER)


def test_rollup_and_reports(spark):
    p = papers(spark, [("1", "cs", "cs.CV", "2020", "ok", ""), ("2", "cs", None, "", "ok", ""), ("3", "math", "math.AG", "2021", "failed", ""), ("4", "math", "math.AG", "x", "queued", ""), ("5", "stat", "", "bad", "ok", "")])
    t = rollup.totals(p).first()
    assert (t.papers_total, t.papers_ok, t.papers_failed, t.pages_total) == (5, 3, 1, 30)
    assert {(r.key, r.n) for r in rollup.histogram(p, "archive").collect()} == {("cs", 2), ("stat", 1)}
    assert {r.key for r in rollup.histogram(p, "primary_category").collect()} == {"cs.CV"}
    assert [(r.key, r.n) for r in rollup.failures(p).collect()] == [("?", 1)] and rollup.failures(p, blank="").first().key == ""
    dim = S.archives_dim(spark, ("cs", "math", "stat"))
    assert [r.archive for r in rollup.untouched(p, dim).collect()] == ["math"]
    h = rollup.health(p, dim).first()
    assert (h.fail_rate, h.fail_level, h.top_archive, h.bottom_archive, h.spread) == (25.0, "good", "cs", "stat", 2.0)
    assert rollup.health(p.filter("false"), dim).first().fail_rate == 0.0
    k = spark.createDataFrame([("figure", 100), ("table", 10)], "key string, n bigint")
    starving = rollup.starving_kinds(k)
    assert [r.kind for r in starving.collect()] == ["algorithm", "table"]
    none = starving.filter("false")
    pick = lambda s, c: rollup.recommendation(s, c, rollup.untouched(p, dim)).first()
    assert (pick(starving, {}).rule, pick(starving, {}).archives) == ("label_balance", ["cs"])
    assert pick(none, {"force_next_archive": "q-bio"}).archives == ["q-bio"] and pick(none, {}).archives == ["math"]


def test_scheduler(spark):
    p = papers(spark, [("1", "cs", None, "2020", "ok", ""), ("2", "cs", None, "2024", "ok", ""), ("3", "math", None, "oops", "ok", "")])
    dim = S.archives_dim(spark, ("cs", "math"))
    assert rollup.next_archive(p, dim).first().archive == "math"
    assert rollup.next_archive(p, dim, quota=1).first() is None
    assert rollup.next_archive(p, dim, quota=1, force="cs").first().archive == "cs"  # forced whatever the quota
    assert rollup.next_archive(p, dim, force="cs", avoid=["cs"]).first().archive == "math"
    b = rollup.next_bucket(p, "cs", S.year_buckets_dim(spark)).first()
    assert (b.lo, b.n) in {(2014, 0), (2007, 0)}
    assert rollup.pick(p, spark, {"skip_archive_query": ["cs", "math"]}, archives=("cs", "math")) is None
    c = spark.createDataFrame([("1", "x"), ("9", "nlin.SI"), ("8", None)], "arxiv_id string, primary_category string")
    got = {r.arxiv_id: (r.status, r.reason) for r in rollup.screened(c, p, ["nlin.SI"]).collect()}
    assert got == {"9": ("failed", "skip_primary_cat:nlin.SI"), "8": ("fetched", "")}
    assert rollup.target_reached(p, max_images=12) and not rollup.target_reached(p, max_images=13, max_papers=4)


def test_state_documents(spark, tmp_path):
    doc = {"version": 1, "papers": {"a": {"arxiv_id": "a", "archive": "cs", "status": "ok", "workspace": "/w/a_slug/"}}}
    (tmp_path / "state.json").write_text(json.dumps(doc))
    (r,) = corpus.read_state(spark, str(tmp_path / "state.json")).collect()
    assert (r.labels_by_kind, r.categories, r.pages_total, r.reason) == ({}, [], 0, "")
    assert corpus.archive_lookup(corpus.read_state(spark, str(tmp_path / "state.json"))).first().paper_id == "a_slug"
    (tmp_path / "new.json").write_text(json.dumps(doc | {"version": 2}))
    with pytest.raises(Exception, match="unsupported state version 2"):
        corpus.read_state(spark, str(tmp_path / "new.json")).collect()
    (tmp_path / "control.json").write_text('{"skip_primary_cats": ["a"]}')
    assert corpus.read_control(spark, str(tmp_path / "control.json")) == {"skip_primary_cats": ["a"]}
    (tmp_path / "bad.json").write_text("[1")
    assert corpus.read_control(spark, str(tmp_path / "bad.json")) == {} == corpus.read_control(spark, str(tmp_path / "missing.json"))


def test_coco_round_trip(spark, tmp_path):
    ann = spark.createDataFrame([("p1", 1, 2, "table", 1.5, 2.0, 3.0, 4.0, 12.0, "table_1"), ("p1", 2, 1, "figure", 0.0, 0.0, 1.0, 1.0, 1.0, "figure_1")], "paper_id string, id int, image_id int, kind string, x double, y double, w double, h double, area double, label_id string")
    cats = spark.createDataFrame([("p1", 0, "figure"), ("p1", 1, "table")], "paper_id string, category_id int, name string")
    images = spark.createDataFrame([("p1", 1, "page_001.png", 10, 20), ("p1", 2, "page_002.png", 10, 20), ("p2", 1, "page_001.png", 10, 20)], "paper_id string, page int, file_name string, width int, height int")
    docs = {r.paper_id: json.loads(r.document) for r in sinks.coco_documents(ann, cats, images).collect()}
    assert docs["p1"]["annotations"][0]["bbox"] == [1.5, 2.0, 3.0, 4.0] and docs["p2"]["annotations"] == [] and docs["p2"]["categories"] == []
    for p, d in docs.items():
        f = tmp_path / p / "dataset" / "annotations.json"
        f.parent.mkdir(parents=True)
        f.write_text(json.dumps(d, indent=2))
    (tmp_path / "p3" / "dataset").mkdir(parents=True)
    (tmp_path / "p3" / "dataset" / "annotations.json").write_text("{broken")
    coco = corpus.read_coco(spark, f"{tmp_path}/*/dataset/annotations.json")
    assert sorted(r.paper_id for r in coco.collect()) == ["p1", "p2"]
    back = corpus.annotations(coco).join(corpus.categories(coco), ["paper_id", "category_id"]).orderBy("ord").collect()
    assert [(r.name, r.page, r.x, r.label_id) for r in back] == [("table", 2, 1.5, "table_1"), ("figure", 1, 0.0, "figure_1")]
    assert corpus.images(coco).count() == 3
    sinks.write_documents(sinks.coco_documents(ann, cats, images), str(tmp_path / "out"))
    one = sinks.manifest_of(spark, str(tmp_path / "p1")).collect()
    assert [r.path for r in one] == ["dataset/annotations.json"] and one == sinks.manifest_of(spark, str(tmp_path / "p1")).collect()


def test_dataset_artefacts(spark, tmp_path):
    row = [("p", 1, "s1", "train", [(0, 1, 0.5, 0.5, 0.25, 0.125)], 1), ("p", 2, "s2", "val", None, 0)]
    pages = spark.createDataFrame(row, "paper_id string, page int, stem string, split string, rows array<struct<ord:bigint,cls:int,cx:double,cy:double,nw:double,nh:double>>, n_rows int")
    files = sinks.label_files(pages)
    assert {r.stem: r.text for r in files.collect()} == {"s1": "1 0.500000 0.500000 0.250000 0.125000", "s2": ""}
    sinks.write_labels(files, str(tmp_path / "labels"))
    assert {r.dir for r in spark.read.parquet(str(tmp_path / "labels")).collect()} == {"train", "valid"}
    meta = json.loads(sinks.dataset_meta(pages, ("figure", "table"), {"gate": "spatial"}).first().document)
    assert meta["totals"]["labels"] == 1 and meta["splits"]["train"]["positive"] == 1
    assert "  1: table" in sinks.data_yaml(("figure", "table")) and "imgsz: 976" in sinks.train_yaml([("figure", 5, 1.0)], 720)
    assert "| 8 | 3 |" in sinks.dataset_card([{"subset": "8", "n": 3}], []) and json.loads(sinks.message_card("t", ["x"], "k"))["title"] == "k t"


def test_catalog(spark):
    pages = {("cs", 0): ["u/abs/1", "u/abs/2"], ("cs", 2): ["u/abs/2", "u/abs/3"], ("cs", 4): ["u/abs/4"], ("math", 0): ["u/abs/2"]}

    def page(archive, start, size):
        if archive == "stat":
            raise OSError
        return [{"id": i, "title": " T ", "published": "2020-01-01", "tags": ["", "cs.CV"], "authors": ["A"], "links": [{"href": "h.pdf", "type": "application/pdf"}]} for i in pages.get((archive, start), [])]

    rows = catalog.catalog_rows(catalog.scan(spark, ["cs", "math", "stat"], page, target=10, page_size=2, sleep=lambda _: None))
    out = {r.arxiv_id: r for r in catalog.dedupe(rows).collect()}
    assert sorted(out) == ["1", "2", "3", "4"] and out["2"].also_in_archives == ["cs", "math"] and out["2"].queried_archive == "cs"
    assert (out["1"].pdf_url, out["1"].title, out["1"].primary_category, out["1"].year, out["1"].categories) == ("h.pdf", "T", "cs.CV", "2020", ["cs.CV"])
    assert catalog.per_archive(rows, 2).filter("queried_archive = 'cs'").count() == 2
    waits: list[float] = []

    class Busy(Exception):
        code = 429

    def fetch(url):
        if len(waits) < 2:
            raise Busy
        if len(waits) < 3:
            raise OSError
        return b"ok"

    assert catalog.call(fetch, "u", sleep=waits.append) == b"ok" and waits == [30, 60, 6]


def test_landed_catalog_is_pruned(spark, tmp_path):
    rows = [(f"p{i}", "", "", "", None, ["cs.AI", "math.CO"] if i % 3 == 0 else ["math.CO"], f"{1990 + i % 40}-01-02" if i % 7 else "unknown") for i in range(400)]
    flat = spark.createDataFrame(rows, "arxiv_id string, title string, abs_url string, source_url string, primary_category string, categories array<string>, published string")
    catalog.land(flat, str(tmp_path / "c"))
    seen = spark.createDataFrame([("p3",)], "arxiv_id string")
    landed = catalog.candidates(spark.read.parquet(str(tmp_path / "c")), "cs", 1995, 2000, seen, 50)
    plain = catalog.candidates(flat, "cs", 1995, 2000, seen, 50)
    assert sorted(landed.collect()) == sorted(plain.collect()) and landed.count() > 5
    plan = landed._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(archive" in plan and "GreaterThanOrEqual(published_year,1995)" in plan and "LessThanOrEqual(published_year,2000)" in plan


def test_upserts_by_stream(spark, tmp_path):
    schema = S.struct("arxiv_id string, status string, seq bigint")
    src = tmp_path / "in"
    batches = [[("a", "fetched", 1), ("b", "ok", 2)], [("a", "failed", 3), ("a", "ok", 4)], [("b", "failed", 1)]]
    want: dict[str, str] = {}
    for k, rows in enumerate(batches):  # the query stops and starts again between the batches
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(src))
        q = live.start_upserts(spark.readStream.schema(schema).parquet(str(src)), str(tmp_path / "state"), str(tmp_path / "cp"), schema, sequence="seq")
        q.awaitTermination()
        want |= {r[0]: r[1] for r in sorted(rows, key=lambda r: r[2])}
        assert {r.arxiv_id: r.status for r in state.load_state(spark, str(tmp_path / "state"), schema).collect()} == want
    assert state.load_state(spark, str(tmp_path / "none"), schema).count() == 0


def test_state_survives_a_crash(spark, tmp_path):
    root, schema = str(tmp_path / "s"), S.struct("arxiv_id string, status string, labels_total bigint")
    frame = lambda rows: spark.createDataFrame(rows, schema)
    rows = lambda: {r.arxiv_id: r.labels_total for r in state.load_state(spark, root, schema).collect()}
    state.save_state(frame([(f"p{i}", "ok", i) for i in range(200)]), root)

    def crash():
        raise OSError("lost")

    with pytest.raises(OSError):  # between the new pieces and the pointer
        state.merge_state(frame([("p1", "ok", 1000)]), root, schema, then=crash)
    assert rows() == {f"p{i}": i for i in range(200)}
    before = {p.name for p in (tmp_path / "s").iterdir() if p.name.startswith("piece-")}
    for _ in range(2):  # the batch runs again
        state.merge_state(frame([("p1", "ok", 1000), ("new", "failed", 5)]), root, schema)
        assert rows() == {f"p{i}": i for i in range(200)} | {"p1": 1000, "new": 5}
    stats = state.load_stats(spark, root)
    assert (stats["papers_total"], stats["papers_ok"], stats["papers_failed"], stats["labels_total"]) == (201, 200, 1, sum(range(200)) - 1 + 1000)
    assert len(before) == 2 and stats["last_updated"].endswith("Z")
    for _ in range(6):
        state.merge_state(frame([("p1", "ok", 7)]), root, schema)
    left = [p for p in (tmp_path / "s").iterdir() if p.name.startswith("piece-")]
    assert len(left) <= 2 + state.KEEP and rows()["p1"] == 7  # old pieces, the lost one too, are gone
    state.merge_state(frame([]), root, schema)
    assert len(rows()) == 201


def test_rollup_stream(spark, tmp_path):
    e = spark.read.parquet("/root/testdata/sf0.001/events.parquet").select(F.col("ts").cast("timestamp").alias("ts"), F.col("event_type").alias("status"))
    e.write.parquet(str(tmp_path / "e"))
    q = live.rollup_stream(spark.readStream.schema(e.schema).parquet(str(tmp_path / "e"))).writeStream.format("memory").queryName("rolled").outputMode("complete").trigger(availableNow=True).start()
    q.awaitTermination()
    assert spark.table("rolled").agg(F.sum("n")).first()[0] == e.count()


def test_loop(spark, tmp_path):
    ids = iter(range(100))

    def query(archive, lo, hi, state, offset):
        rows = [(f"{archive}{next(ids)}", "x.Y" if k else "bad.C", str(lo)) for k in range(2)] if archive != "dry" else []
        return spark.createDataFrame(rows, "arxiv_id string, primary_category string, year string")

    def process(df):
        return df.withColumns({"status": F.lit("ok"), "pages_with_labels": F.lit(3).cast("bigint")})

    (tmp_path / "control.json").write_text('{"skip_primary_cats": ["bad.C"]}')
    seen = []
    loop = live.CorpusLoop(spark, str(tmp_path / "s"), query, process, control=str(tmp_path / "control.json"), archives=("cs", "math"), max_papers=3, report_every=2, report=seen.append)
    loop.run(10)
    t = rollup.totals(loop.state).first()
    assert (t.papers_ok, t.papers_failed, loop.steps) == (3, 3, 3) and seen and seen[0]["papers_ok"] == 1
    assert {r.reason for r in loop.state.filter("status = 'failed'").collect()} == {"skip_primary_cat:bad.C"}
    dry = live.CorpusLoop(spark, str(tmp_path / "d"), query, process, archives=("dry",), batch=5)
    assert dry.run(3) == 3 and dry.offsets == {"dry": 15}
    dry.stop()
    assert dry.run() == 0
