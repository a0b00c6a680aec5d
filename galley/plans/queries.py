"""Registered queries over the adapter relations, each with the SQL that DuckDB answers alike.

A query is a function of (spark, sf_dir); ORACLES has SQL by the same name where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from galley import schemas as S
from galley.functions import geometry as G
from galley.functions import text as T
from galley.operators import gates, golden, histograms, labels, resolve, rollup, sampling
from galley.plans import adapters as A
from galley.plans.adapters import with_sql
from galley.sources import catalog, typeset
from galley.streaming import corpus as stream

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}
CLASSES6 = S.SUBSETS["6"]


def query(sql: str | None = None, *adapters: str):
    """Registers a query under its function's name; sql runs over the adapters named."""

    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLES[f.__name__] = with_sql(sql, *adapters) if adapters else sql.strip()
        return f

    return add


# gates --------------------------------------------------------------------------------------------

_SIDES = """b AS (SELECT * FROM annotations WHERE i > 0), c AS (SELECT *, replace(kind, '_cap', '') AS family FROM annotations WHERE i = 0),
    pairs AS (SELECT b.paper_id, b.page, b.kind AS family, b.float_id AS bf, b.i AS bi, c.float_id AS cf FROM b JOIN c ON b.paper_id = c.paper_id AND b.page = c.page AND b.kind = c.family
      WHERE greatest(0, least(b.x + b.w, c.x + c.w) - greatest(b.x, c.x)) * greatest(0, least(b.y + b.h, c.y + c.h) - greatest(b.y, c.y)) / greatest(1e-9, b.w * b.h) >= 0.9),
    orphans AS (SELECT b.* FROM b WHERE NOT EXISTS (SELECT 1 FROM pairs p WHERE p.bf = b.float_id AND p.bi = b.i)),
    empties AS (SELECT c.* FROM c WHERE NOT EXISTS (SELECT 1 FROM pairs p WHERE p.cf = c.float_id)),
    uneven AS (SELECT paper_id, page, replace(kind, '_cap', '') AS family FROM annotations GROUP BY ALL HAVING count(*) FILTER (i = 0) <> count(*) FILTER (i > 0))"""
_BAD = _SIDES + ", bad AS (SELECT paper_id, kind AS family FROM orphans UNION SELECT paper_id, family FROM empties)"
_PASS = _BAD + """, everyone AS (SELECT DISTINCT paper_id, subset FROM images, (SELECT DISTINCT subset FROM subsets)),
    good AS (SELECT subset, paper_id FROM everyone e WHERE NOT EXISTS (SELECT 1 FROM bad JOIN subsets s USING (family) WHERE bad.paper_id = e.paper_id AND s.subset = e.subset))"""
_GATE = ("annotations", "images", "subsets")


@query(f"WITH {_PASS} SELECT subset, count(*) AS papers FROM good GROUP BY subset", *_GATE)
def spatial_pair_pass(spark, d):
    return gates.passing(A.annotations(spark, d), A.images(spark, d)).groupBy("subset").agg(F.count(F.lit(1)).alias("papers"))


@query(
    f"""WITH {_SIDES}, bad AS (SELECT paper_id, kind AS family FROM orphans UNION SELECT paper_id, family FROM empties UNION SELECT paper_id, family FROM uneven),
    everyone AS (SELECT DISTINCT paper_id, subset FROM images, (SELECT DISTINCT subset FROM subsets))
    SELECT subset, count(*) AS papers FROM everyone e WHERE NOT EXISTS (SELECT 1 FROM bad JOIN subsets s USING (family) WHERE bad.paper_id = e.paper_id AND s.subset = e.subset) GROUP BY subset""",
    *_GATE,
)
def spatial_pair_strict(spark, d):
    return gates.passing(A.annotations(spark, d), A.images(spark, d), strict=True).groupBy("subset").agg(F.count(F.lit(1)).alias("papers"))


@query(f"WITH {_SIDES} SELECT paper_id, page, kind AS family, count(*) AS n FROM orphans GROUP BY ALL", "annotations")
def orphan_bodies(spark, d):
    return gates.orphan_bodies(A.annotations(spark, d)).groupBy("paper_id", "page", "family").agg(F.count(F.lit(1)).alias("n"))


@query(f"WITH {_SIDES} SELECT paper_id, page, family, count(*) AS n FROM empties GROUP BY ALL", "annotations")
def empty_caps(spark, d):
    return gates.empty_caps(A.annotations(spark, d)).groupBy("paper_id", "page", "family").agg(F.count(F.lit(1)).alias("n"))


@query(f"WITH {_SIDES} SELECT * FROM uneven", "annotations")
def uneven_pages(spark, d):
    return gates.uneven_pages(A.annotations(spark, d))


@query(f"WITH {_PASS} SELECT p.paper_id, bool_or(g.subset = '8') AS ok8, bool_or(g.subset = '4') AS ok4 FROM (SELECT DISTINCT paper_id FROM images) p LEFT JOIN good g USING (paper_id) GROUP BY p.paper_id", *_GATE)
def qualification(spark, d):
    q = gates.qualification(A.annotations(spark, d), A.images(spark, d))
    # a paper that passes nothing has no row on the right in SQL, hence null there
    none = ~F.exists(F.map_values("ok"), lambda x: x)
    return q.select("paper_id", F.when(~none, F.col("ok")["8"]).alias("ok8"), F.when(~none, F.col("ok")["4"]).alias("ok4"))


_TABLE = f"""WITH {_PASS}, stats AS (SELECT s.subset, t.paper_id, t.n AS pages_total, t.n - coalesce(a.n, 0) AS pages_without FROM (SELECT paper_id, count(DISTINCT page) AS n FROM images GROUP BY 1) t
      CROSS JOIN (SELECT DISTINCT subset FROM subsets) s LEFT JOIN (SELECT u.subset, paper_id, count(DISTINCT page) AS n FROM annotations JOIN subsets u ON u.family = replace(kind, '_cap', '') WHERE page BETWEEN 1 AND 9 GROUP BY ALL) a ON a.paper_id = t.paper_id AND a.subset = s.subset),
    boxes AS (SELECT g.subset, a.kind, count(*) AS n FROM good g JOIN annotations a USING (paper_id) GROUP BY ALL)"""


@query(
    _TABLE
    + """ SELECT subset, count(*) AS papers_pass, CAST(sum(pages_total) AS BIGINT) AS pages_total, CAST(sum(pages_without) AS BIGINT) AS pages_without, """
    + ", ".join(f"coalesce((SELECT n FROM boxes b WHERE b.subset = g.subset AND b.kind = '{k}'), 0) AS {k}" for k in S.CLASSES)
    + " FROM good g JOIN stats USING (subset, paper_id) GROUP BY subset",
    *_GATE,
)
def subset_table(spark, d):
    return gates.subset_table(A.annotations(spark, d), A.images(spark, d))


@query(
    _TABLE
    + """, long AS (SELECT subset, 'papers_pass' AS metric, count(*) AS n FROM good GROUP BY 1 UNION ALL SELECT subset, 'pages_total', sum(pages_total) FROM good JOIN stats USING (subset, paper_id) GROUP BY 1
      UNION ALL SELECT subset, 'pages_without', sum(pages_without) FROM good JOIN stats USING (subset, paper_id) GROUP BY 1
      UNION ALL SELECT s.subset, k.kind, coalesce(b.n, 0) FROM (SELECT DISTINCT subset FROM subsets) s CROSS JOIN (SELECT unnest(["""
    + ", ".join(f"'{k}'" for k in S.CLASSES)
    + """]) AS kind) k LEFT JOIN boxes b USING (subset, kind))
    SELECT metric, max(CAST(n AS VARCHAR)) FILTER (subset = '8') AS c8, max(CASE WHEN metric LIKE 'listing%' THEN '--' ELSE CAST(n AS VARCHAR) END) FILTER (subset = '6') AS c6,
      max(CASE WHEN metric LIKE 'listing%' OR metric LIKE 'algorithm%' THEN '--' ELSE CAST(n AS VARCHAR) END) FILTER (subset = '4') AS c4 FROM long GROUP BY metric""",
    *_GATE,
)
def subset_report(spark, d):
    return gates.subset_report(gates.subset_table(A.annotations(spark, d), A.images(spark, d)))


@query("SELECT paper_id, kind, count(*) AS n FROM annotations GROUP BY ALL", "annotations")
def kind_counts(spark, d):
    return gates.kind_counts(A.annotations(spark, d))


@query(
    """SELECT s.subset, t.paper_id, t.n AS pages_total, t.n - coalesce(a.n, 0) AS pages_without FROM (SELECT paper_id, count(DISTINCT page) AS n FROM images GROUP BY 1) t CROSS JOIN (SELECT DISTINCT subset FROM subsets) s
    LEFT JOIN (SELECT u.subset, paper_id, count(DISTINCT page) AS n FROM annotations JOIN subsets u ON u.family = replace(kind, '_cap', '') WHERE page BETWEEN 1 AND 9 GROUP BY ALL) a ON a.paper_id = t.paper_id AND a.subset = s.subset""",
    *_GATE,
)
def pages_label_stats(spark, d):
    return gates.page_stats(A.annotations(spark, d), A.images(spark, d))


@query(
    """WITH c AS (SELECT paper_id, page, count(*) AS boxes FROM annotations GROUP BY ALL), e AS (SELECT paper_id, page, 0 AS boxes FROM images i WHERE NOT EXISTS (SELECT 1 FROM c WHERE c.paper_id = i.paper_id AND c.page = i.page))
    SELECT paper_id, boxes, count(*) AS n FROM (SELECT * FROM c UNION ALL SELECT * FROM e) GROUP BY ALL""",
    "annotations", "images",
)
def boxes_per_page_hist(spark, d):
    return histograms.boxes_per_page(A.annotations(spark, d, dealt=False), A.images(spark, d))


# labels -------------------------------------------------------------------------------------------

_UNIT = ", ".join(f"greatest(0.0, least({e}, 1.0)) AS {n}" for e, n in (("(x + w / 2) / width", "cx"), ("(y + h / 2) / height", "cy"), ("w / width", "nw"), ("h / height", "nh")))
_CLS = "CASE kind " + " ".join(f"WHEN '{k}' THEN {i}" for i, k in enumerate(S.CLASSES)) + " END"
_ROWS = f"rows AS (SELECT a.paper_id, a.page, a.float_id, a.i, {_CLS} AS cls, {_UNIT} FROM annotations a JOIN images USING (paper_id, page))"
_LAB = ("annotations", "images")


def _rows(spark, d, **how):
    return labels.normalised(A.annotations(spark, d).withColumn("ord", F.xxhash64("float_id", "i")), A.images(spark, d), **how)


@query(f"WITH {_ROWS} SELECT paper_id, page, cls || ' ' || printf('%.6f', cx) || ' ' || printf('%.6f', cy) || ' ' || printf('%.6f', nw) || ' ' || printf('%.6f', nh) AS line, count(*) AS n FROM rows GROUP BY ALL", *_LAB)
def yolo_rows(spark, d):
    return labels.label_rows(_rows(spark, d)).groupBy("paper_id", "page", "line").agg(F.count(F.lit(1)).alias("n"))


@query(f"WITH {_ROWS} SELECT cls, count(*) AS n FROM rows WHERE nw * nh >= 0.02 GROUP BY ALL", *_LAB)
def min_area_filter(spark, d):
    return _rows(spark, d, min_area=0.02).groupBy("cls").agg(F.count(F.lit(1)).alias("n"))


@query(f"WITH {_ROWS} SELECT paper_id FROM rows GROUP BY 1 HAVING count(*) > 16", *_LAB)
def label_cap(spark, d):
    return labels.crowded_papers(_rows(spark, d), 16)


_SPLIT = "CASE WHEN ('0x' || substr(sha256({s}), 1, 16))::UBIGINT % 10 < 8 THEN 'train' WHEN ('0x' || substr(sha256({s}), 1, 16))::UBIGINT % 10 < 9 THEN 'val' ELSE 'test' END"
_STEM = "paper_id || '__page_' || printf('%03d', page)"


@query(f"SELECT stem, {_SPLIT.format(s='stem')} AS split FROM (SELECT {_STEM} AS stem FROM images)", "images")
def hash_split(spark, d):
    s = A.images(spark, d).select(T.stem(F.col("paper_id").cast("string"), F.col("page")).alias("stem"))
    return s.select("stem", T.hash_split(F.col("stem")).alias("split"))


def _pages(spark, d):
    archives = A.papers(spark, d).select(F.col("arxiv_id").alias("paper_id"), "archive")
    return labels.page_candidates(_rows(spark, d), A.images(spark, d), archives=archives)


_PAGES = f"""{_ROWS}, pages AS (SELECT i.paper_id, i.page, i.width, i.height, {_SPLIT.format(s=_STEM)} AS split, coalesce(p.archive, 'unknown') AS archive, coalesce(r.n, 0) AS n_rows FROM images i
    LEFT JOIN (SELECT paper_id, page, count(*) AS n FROM rows GROUP BY ALL) r USING (paper_id, page) LEFT JOIN (SELECT arxiv_id AS paper_id, archive FROM papers) p USING (paper_id))"""
_PG = ("annotations", "images", "papers")


@query(f"WITH {_PAGES} SELECT split, count(*) AS pages, count(*) FILTER (n_rows > 0) AS positive, count(*) FILTER (n_rows = 0) AS negative FROM pages GROUP BY split", *_PG)
def split_totals(spark, d):
    return histograms.split_totals(_pages(spark, d))


@query(f"WITH {_PAGES} SELECT p.split, r.cls, count(*) AS n FROM rows r JOIN pages p USING (paper_id, page) GROUP BY ALL", *_PG)
def class_by_split(spark, d):
    return histograms.class_by_split(_pages(spark, d))


@query(
    f"WITH {_PAGES} SELECT p.archive, count(DISTINCT p.paper_id) AS papers, count(DISTINCT (p.paper_id, p.page)) AS pages, "
    + ", ".join(f"count(r.cls) FILTER (r.cls = {i}) AS c{i}" for i in range(8))
    + " FROM pages p LEFT JOIN rows r USING (paper_id, page) GROUP BY p.archive",
    *_PG,
)
def archive_by_class(spark, d):
    return histograms.archive_by_class(_pages(spark, d), 8)


@query(
    f"""WITH {_ROWS}, n AS (SELECT k.kind, coalesce(r.n, 0) AS n FROM (SELECT unnest([{", ".join(f"'{k}'" for k in S.CLASSES)}]) AS kind, unnest(range(8)) AS cls) k LEFT JOIN (SELECT cls, count(*) AS n FROM rows GROUP BY 1) r USING (cls))
    SELECT kind, n, CASE WHEN n = 0 THEN 30.0 ELSE round(greatest(1.0, least(30.0, (SELECT max(n) FROM n)::DOUBLE / n)), 2) END::DOUBLE AS weight FROM n""",
    *_LAB,
)
def class_weights(spark, d):
    return histograms.class_weights(_rows(spark, d).groupBy("cls").agg(F.count(F.lit(1)).alias("n")), S.classes_dim(spark))


@query(f"WITH {_PAGES}, ranked AS (SELECT *, row_number() OVER (PARTITION BY paper_id ORDER BY n_rows = 0, CASE WHEN n_rows > 0 THEN page END NULLS FIRST, sha256('0|' || {_STEM})) AS k FROM pages) SELECT paper_id, page FROM ranked WHERE k <= 4", *_PG)
def page_cap(spark, d):
    return labels.cap_pages(_pages(spark, d), 4).select("paper_id", "page")


@query(
    f"""WITH {_BAD}, ok AS (SELECT DISTINCT paper_id FROM images WHERE paper_id NOT IN (SELECT paper_id FROM bad)), {_ROWS},
    crowded AS (SELECT paper_id FROM rows JOIN ok USING (paper_id) GROUP BY 1 HAVING count(*) > 16), fits AS (SELECT paper_id FROM ok WHERE paper_id NOT IN (SELECT paper_id FROM crowded)),
    shown AS (SELECT DISTINCT paper_id, page FROM rows JOIN fits USING (paper_id))
    SELECT * FROM (SELECT 'papers_no_spatial_pair' AS reason, count(DISTINCT paper_id) AS n FROM bad UNION ALL SELECT 'papers_too_many_labels', count(*) FROM crowded
      UNION ALL SELECT 'no_labels', (SELECT count(*) FROM images JOIN fits USING (paper_id)) - (SELECT count(*) FROM shown WHERE page BETWEEN 1 AND 9)
      UNION ALL SELECT 'pages_per_paper_cap', CAST(coalesce(sum(greatest(n - 2, 0)), 0) AS BIGINT) FROM (SELECT count(*) AS n FROM shown GROUP BY paper_id)) WHERE n > 0""",
    *_LAB,
)
def skip_reason_counts(spark, d):
    return labels.skip_reasons(A.annotations(spark, d).withColumn("ord", F.lit(0)), A.images(spark, d), max_labels=16, max_pages=2, include_negatives=False)


@query(
    f"""WITH {_BAD}, ok AS (SELECT DISTINCT paper_id FROM images WHERE paper_id NOT IN (SELECT paper_id FROM bad WHERE family <> 'listing')), {_PAGES},
    fits AS (SELECT paper_id FROM ok WHERE paper_id NOT IN (SELECT paper_id FROM rows GROUP BY 1 HAVING count(*) > 24)),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY paper_id ORDER BY n_rows = 0, CASE WHEN n_rows > 0 THEN page END NULLS FIRST, sha256('0|' || {_STEM})) AS k FROM pages JOIN fits USING (paper_id))
    SELECT {_STEM} AS stem, split, archive, n_rows FROM ranked WHERE k <= 3""",
    *_PG,
)
def export_candidates(spark, d):
    archives = A.papers(spark, d).select(F.col("arxiv_id").alias("paper_id"), "archive")
    ann = A.annotations(spark, d).withColumn("ord", F.xxhash64("float_id", "i"))
    return labels.export_candidates(ann, A.images(spark, d), classes=CLASSES6, max_labels=24, max_pages=3, archives=archives).select("stem", "split", "archive", "n_rows")


# histograms ---------------------------------------------------------------------------------------


@query(f"WITH {_ROWS} SELECT cls, CAST(least(floor(cx * 30), 29) AS INT) AS bx, CAST(least(floor(cy * 30), 29) AS INT) AS by, count(*) AS n FROM rows GROUP BY ALL", *_LAB)
def center_hist2d(spark, d):
    return histograms.center_2d(_rows(spark, d))


@query(f"WITH {_ROWS} SELECT cls, CAST(least(floor(ln(nw / nh / 0.2) / ln(100.0) * 39), 38) AS INT) AS bin, count(*) AS n FROM rows WHERE nh > 0 AND nw / nh BETWEEN 0.2 AND 20 GROUP BY ALL", *_LAB)
def aspect_hist(spark, d):
    return histograms.aspect(_rows(spark, d))


@query(f"WITH {_ROWS} SELECT cls, CAST(least(floor(nw * nh * 40), 39) AS INT) AS bin, count(*) AS n FROM rows GROUP BY ALL", *_LAB)
def area_hist(spark, d):
    return histograms.box_area(_rows(spark, d))


@query("WITH v AS (SELECT width::DOUBLE / height AS v FROM images), r AS (SELECT min(v) AS lo, max(v) AS hi FROM v) SELECT CAST(least(floor((v - lo) / (hi - lo) * 40), 39) AS INT) AS bin, count(*) AS n FROM v, r GROUP BY ALL", "images")
def page_aspect_hist(spark, d):
    return histograms.page_aspect(A.images(spark, d))


@query(f"WITH {_PAGES}, t AS (SELECT least(6, max(n_rows)) AS c FROM pages) SELECT CAST(least(n_rows, c) AS INT) AS labels, count(*) AS n FROM pages, t WHERE n_rows <= c + 1 GROUP BY ALL", *_PG)
def labels_per_page_hist(spark, d):
    return histograms.labels_per_page(_pages(spark, d), most=6)


# corpus -------------------------------------------------------------------------------------------

_ARCH = "(VALUES ('1-URGENT', 0), ('2-HIGH', 1), ('3-MEDIUM', 2), ('4-NOT SPECIFIED', 3), ('5-LOW', 4), ('6-NEVER', 5), ('7-NEVER', 6)) a(archive, ord)"
_BUCKETS = "(VALUES (1999, 2001, 0), (1997, 1998, 1), (1996, 1996, 2), (1990, 1995, 3)) b(lo, hi, ord)"


def _archives(spark):
    return S.archives_dim(spark, ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW", "6-NEVER", "7-NEVER"))


def _buckets(spark):
    return S.year_buckets_dim(spark, ((1999, 2001), (1997, 1998), (1996, 1996), (1990, 1995)))


@query(
    """SELECT count(*) AS papers_total, count(*) FILTER (status = 'ok') AS papers_ok, count(*) FILTER (status = 'failed') AS papers_failed,
    CAST(sum(pages_total) FILTER (status = 'ok') AS BIGINT) AS pages_total, CAST(sum(pages_with_labels) FILTER (status = 'ok') AS BIGINT) AS pages_with_labels, CAST(sum(labels_total) FILTER (status = 'ok') AS BIGINT) AS labels_total FROM papers""",
    "papers",
)
def corpus_rollup(spark, d):
    return rollup.totals(A.papers(spark, d))


@query("SELECT archive AS key, count(*) AS n FROM papers WHERE status = 'ok' GROUP BY 1", "papers")
def archive_hist(spark, d):
    return rollup.histogram(A.papers(spark, d), "archive")


@query("SELECT year AS key, count(*) AS n FROM papers WHERE status = 'ok' AND year <> '' GROUP BY 1", "papers")
def year_hist(spark, d):
    return rollup.histogram(A.papers(spark, d), "year")


@query("SELECT primary_category AS key, count(*) AS n FROM papers WHERE status = 'ok' AND primary_category IS NOT NULL GROUP BY 1 ORDER BY n DESC, key LIMIT 10", "papers")
def category_topk(spark, d):
    return rollup.top(rollup.histogram(A.papers(spark, d), "primary_category"), 10)


@query("SELECT archive AS key, count(*) AS n FROM papers WHERE status = 'ok' GROUP BY 1 ORDER BY n, key LIMIT 3", "papers")
def bottom_archives(spark, d):
    return rollup.top(rollup.histogram(A.papers(spark, d), "archive"), 3, ascending=True)


@query(
    """SELECT dimension, key, count(*) AS n FROM (SELECT 'archive' AS dimension, archive AS key FROM papers WHERE status = 'ok' UNION ALL SELECT 'year', year FROM papers WHERE status = 'ok' AND year <> ''
    UNION ALL SELECT 'primary_category', primary_category FROM papers WHERE status = 'ok' AND primary_category IS NOT NULL) GROUP BY ALL""",
    "papers",
)
def all_histograms(spark, d):
    return rollup.histograms(A.papers(spark, d))


@query("SELECT unnest(['figure', 'table', 'algorithm']) AS key, unnest([CAST(sum(n_figure) AS BIGINT), CAST(sum(n_table) AS BIGINT), CAST(sum(n_algorithm) AS BIGINT)]) AS n FROM papers WHERE status = 'ok'", "papers")
def merged_kind_map(spark, d):
    return rollup.merged_map(A.papers(spark, d))


@query("SELECT CASE WHEN reason = '' THEN '?' ELSE reason END AS key, count(*) AS n FROM papers WHERE status = 'failed' GROUP BY 1", "papers")
def fail_reasons(spark, d):
    return rollup.failures(A.papers(spark, d))


@query("SELECT reason AS key, count(*) AS n FROM papers WHERE status = 'failed' GROUP BY 1", "papers")
def fail_reasons_raw(spark, d):
    return rollup.failures(A.papers(spark, d), blank="")


@query("SELECT coalesce(primary_category, '?') AS key, count(*) AS n FROM papers WHERE status = 'failed' GROUP BY 1 ORDER BY n DESC, key LIMIT 8", "papers")
def fails_by_cat(spark, d):
    return rollup.top(rollup.failures(A.papers(spark, d), "primary_category"), 8)


@query(f"SELECT archive FROM {_ARCH} WHERE archive NOT IN (SELECT archive FROM papers WHERE status = 'ok')", "papers")
def untouched_archives(spark, d):
    return rollup.untouched(A.papers(spark, d), _archives(spark))


@query(f"SELECT archive FROM {_ARCH} WHERE archive IN (SELECT archive FROM papers WHERE status = 'ok')", "papers")
def covered_archives(spark, d):
    return rollup.covered(A.papers(spark, d), _archives(spark))


@query(
    """WITH s AS (SELECT sum(n_figure) AS f, sum(n_table) AS t, sum(n_algorithm) AS a FROM papers WHERE status = 'ok'), l AS (SELECT 'algorithm' AS kind, a AS n, f FROM s UNION ALL SELECT 'table', t, f FROM s)
    SELECT kind, CAST(n AS BIGINT) AS n, round(f / greatest(1, n), 6)::DOUBLE AS ratio FROM l WHERE f > 0 AND f / greatest(1, n) > 4""",
    "papers",
)
def starving_kinds(spark, d):
    return rollup.starving_kinds(rollup.merged_map(A.papers(spark, d))).withColumn("ratio", F.round("ratio", 6))


@query(
    f"""WITH t AS (SELECT count(*) AS papers_total, count(*) FILTER (status = 'ok') AS papers_ok, count(*) FILTER (status = 'failed') AS papers_failed, sum(pages_total) FILTER (status = 'ok') AS p, sum(pages_with_labels) FILTER (status = 'ok') AS w FROM papers),
    a AS (SELECT a.archive, ord, count(*) AS n FROM {_ARCH} JOIN papers p ON p.archive = a.archive AND p.status = 'ok' GROUP BY ALL)
    SELECT papers_total, papers_ok, papers_failed, round(papers_failed * 100.0::DOUBLE / (papers_ok + papers_failed), 6) AS fail_rate,
      CASE WHEN papers_failed * 100.0 / (papers_ok + papers_failed) <= 30 THEN 'good' WHEN papers_failed * 100.0 / (papers_ok + papers_failed) <= 40 THEN 'warn' ELSE 'bad' END AS fail_level,
      round(greatest(0, p - w) * 100.0::DOUBLE / p, 6) AS negative_share, (SELECT count(*) FROM a) AS covered, (SELECT archive FROM a ORDER BY n DESC, ord LIMIT 1) AS top_archive, (SELECT archive FROM a ORDER BY n, ord LIMIT 1) AS bottom_archive,
      round((SELECT max(n) FROM a) / greatest(1, (SELECT min(n) FROM a))::DOUBLE, 6) AS spread FROM t""",
    "papers",
)
def health_report(spark, d):
    return rollup.health(A.papers(spark, d), _archives(spark))


@query(f"SELECT a.archive, count(p.arxiv_id) AS n FROM {_ARCH} LEFT JOIN papers p ON p.archive = a.archive AND p.status = 'ok' WHERE a.archive <> '7-NEVER' GROUP BY a.archive ORDER BY n, sha256('3|' || a.archive) LIMIT 1", "papers")
def next_archive(spark, d):
    return rollup.next_archive(A.papers(spark, d), _archives(spark), quota=100_000, avoid=["7-NEVER"], seed=3)


@query(
    f"""WITH y AS (SELECT try_cast(left(year, 4) AS INT) AS y FROM papers WHERE status = 'ok' AND archive = '2-HIGH')
    SELECT lo, hi, (SELECT count(*) FROM y WHERE y BETWEEN lo AND hi) AS n FROM {_BUCKETS} ORDER BY n, sha256('0|2-HIGH|' || lo) LIMIT 1""",
    "papers",
)
def next_year_bucket(spark, d):
    return rollup.next_bucket(A.papers(spark, d), "2-HIGH", _buckets(spark))


@query(f"SELECT archive, lo, hi, ord, count(*) AS n FROM papers JOIN {_BUCKETS} ON try_cast(left(year, 4) AS INT) BETWEEN lo AND hi WHERE status = 'ok' GROUP BY ALL", "papers")
def year_bucket_join(spark, d):
    return rollup.bucket_counts(A.papers(spark, d), _buckets(spark)).withColumn("n", F.col("n").cast("bigint"))


@query(
    """SELECT CASE WHEN coalesce(primary_category, '') = '1-URGENT.3' THEN 'failed' ELSE 'fetched' END AS status, count(*) AS n FROM papers WHERE arxiv_id NOT IN (SELECT arxiv_id FROM papers WHERE status = 'ok') GROUP BY 1""",
    "papers",
)
def seen_anti_join(spark, d):
    p = A.papers(spark, d)
    return rollup.screened(p, rollup.ok(p), ["1-URGENT.3"]).groupBy("status").agg(F.count(F.lit(1)).alias("n"))


@query(
    """SELECT arxiv_id, left(CASE WHEN suffix <> '' THEN arxiv_id || '_' || replace(archive, '-', '') || '_' || suffix ELSE arxiv_id || '_' || archive END, 90) AS slug, regexp_replace(arxiv_id || 'v2', 'v\\d+$', '') AS stub
    FROM (SELECT CAST(p_partkey AS VARCHAR) AS arxiv_id, p_brand AS archive, left(array_to_string(list_filter(string_split(trim(regexp_replace(lower(p_name || ' - ' || p_type), '[^a-zA-Z0-9]+', '_', 'g'), '_'), '_')[1:6], lambda w: w <> ''), '_'), 40) AS suffix FROM part)"""
)
def slugify(spark, d):
    p = A.table(spark, d, "part").select(F.col("p_partkey").cast("string").alias("arxiv_id"), F.col("p_brand").alias("archive"), F.concat_ws(" - ", "p_name", "p_type").alias("title"))
    return p.select("arxiv_id", T.slug(F.col("arxiv_id"), F.col("title"), F.col("archive")).alias("slug"), T.without_version(F.concat("arxiv_id", F.lit("v2"))).alias("stub"))


# samples ------------------------------------------------------------------------------------------

_POS, _NEG = "pos AS (SELECT * FROM samples WHERE len(cls) > 0)", "neg AS (SELECT * FROM samples WHERE len(cls) = 0)"


def _rr(src: str, n: int, first: str = "") -> str:
    return f"SELECT stem FROM (SELECT *, row_number() OVER (PARTITION BY archive ORDER BY {first}sha256('7|' || stem), stem) AS k FROM {src}) ORDER BY k, sha256('7|' || archive), archive LIMIT {n}"


@query(f"WITH {_POS} SELECT stem FROM pos ORDER BY sha256('7|' || stem), stem LIMIT 100", "samples")
def sample_random(spark, d):
    return sampling.sample(A.samples(spark, d), 100, "random", 7).select("stem")


@query(f"WITH {_POS}, {_NEG} (SELECT * FROM ({_rr('pos', 70)})) UNION ALL (SELECT * FROM ({_rr('neg', 30)}))", "samples")
def sample_by_archive(spark, d):
    return sampling.sample(A.samples(spark, d), 100, "by-archive", 7, ratio=0.3).select("stem")


_RARE = f"{_POS}, f AS (SELECT k, count(*) AS freq FROM (SELECT unnest(cls) AS k FROM pos) GROUP BY 1), rare AS (SELECT stem, round(sum(1.0::DOUBLE / greatest(1, freq)), 9) AS rarity FROM (SELECT stem, unnest(cls) AS k FROM pos) JOIN f USING (k) GROUP BY 1)"


@query(f"WITH {_RARE} SELECT stem, rarity FROM rare", "samples")
def rarity_score(spark, d):
    return sampling.rarity(sampling.positives(A.samples(spark, d)))


@query(f"WITH {_RARE}, scored AS (SELECT * FROM pos JOIN rare USING (stem)) {_rr('scored', 100, 'rarity DESC, ')}", "samples")
def sample_balanced(spark, d):
    return sampling.sample(A.samples(spark, d), 100, "balanced", 7).select("stem")


@query(
    f"""WITH {_POS}, r AS (SELECT stem, k, row_number() OVER (PARTITION BY k ORDER BY sha256('7|' || stem), stem) AS r FROM (SELECT DISTINCT stem, unnest(cls) AS k FROM pos)),
    t AS (SELECT stem, r, sha256('7|' || k) AS ko, row_number() OVER (PARTITION BY stem ORDER BY r, sha256('7|' || k)) AS b FROM r)
    SELECT stem FROM t WHERE b = 1 ORDER BY r, ko, stem LIMIT 100""",
    "samples",
)
def sample_class_balanced(spark, d):
    return sampling.sample(A.samples(spark, d), 100, "class-balanced", 7).select("stem")


@query(
    f"""WITH {_POS}, {_NEG}, t AS (SELECT CAST(round_even((SELECT count(*) FROM pos)::DOUBLE / 0.8 * 0.2, 0) AS BIGINT) AS k)
    (SELECT stem FROM pos) UNION ALL (SELECT stem FROM (SELECT stem, row_number() OVER (ORDER BY sha256('7|' || stem), stem) AS r FROM neg), t WHERE r <= k)""",
    "samples",
)
def cap_negatives(spark, d):
    return sampling.cap_negatives(A.samples(spark, d), 0.2, 7).select("stem")


@query("SELECT stem FROM samples ORDER BY len(cls) = 0, sha256('0|' || stem), stem LIMIT 16", "samples")
def preview_pick(spark, d):
    return sampling.preview(A.samples(spark, d)).select("stem")


# parsing and resolving ----------------------------------------------------------------------------


def _texts(spark, d):
    """An .aux and .log text for each order: an anchor pair, a box and a mark a line item, in order of float id."""
    f = A.floats(spark, d).select("paper_id", "page", "float_id", "x", "y", "n", "dx")
    a = lambda side, x: F.format_string(f"\\zref@newlabel{{%s-{side}}}{{\\posx{{%d}}\\posy{{%d}}\\abspage{{%d}}}}", "float_id", x * 65536, (F.col("y") + 200) * 65536, "page")
    aux = F.concat_ws("\n", a("preL", F.col("x")), a("postR", F.col("x") + 300 + F.col("dx")), a("preL", F.col("x") + F.col("n")))
    log = F.format_string("ARXIVLAYOUT-BOX id=%s width=%d.5pt height=%dpt depth=2.25pt\nnoise\nARXIVLAYOUT-MARK id=%s hsize=%d.0pt linewidth=%d.5pt columnwidth=240.0pt", "float_id", F.col("n") * 100, F.col("n") + 20, "float_id", F.col("n") * 70, F.col("n") * 60)
    lines = lambda c: F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("float_id", c.alias("t")))), lambda r: r.t), "\n")
    head = F.format_string("ARXIVLAYOUT-PAGEINFO paperwidth=614.295pt paperheight=%d.5pt textwidth=430pt textheight=bad oddsidemargin=-12.25pt topmargin=655360sp\nARXIVLAYOUT-PAGEINFO paperwidth=1pt", F.col("paper_id") % 100 + 700)
    return f.groupBy("paper_id").agg(lines(aux).alias("aux"), F.concat_ws("\n", head, lines(log)).alias("log"))


def _aux(spark, d):
    return _texts(spark, d).select("paper_id", F.col("aux").alias("text"))


def _log(spark, d):
    return _texts(spark, d).select("paper_id", F.col("log").alias("text"))


_ANCHORS = """anchors AS (SELECT paper_id, float_id || '-preL' AS name, (x + n) * 65536 AS posx_sp, (y + 200) * 65536 AS posy_sp, page AS abspage FROM floats
    UNION ALL SELECT paper_id, float_id || '-postR', (x + 300 + dx) * 65536, (y + 200) * 65536, page FROM floats)"""


@query(f"WITH {_ANCHORS} SELECT DISTINCT paper_id, name, CAST(posx_sp AS BIGINT) AS posx_sp, CAST(posy_sp AS BIGINT) AS posy_sp, CAST(abspage AS BIGINT) AS abspage FROM anchors", "floats")
def aux_parse(spark, d):
    return typeset.anchors(_aux(spark, d))


@query("SELECT paper_id, float_id AS box_id, CAST(round_even((n * 100 + 0.5)::DOUBLE * 65536, 0) AS BIGINT) AS width_sp, CAST((n + 20) * 65536 AS BIGINT) AS height_sp, CAST(147456 AS BIGINT) AS depth_sp, CAST(0 AS BIGINT) AS hsize_sp FROM floats", "floats")
def log_box_parse(spark, d):
    return typeset.boxes(_log(spark, d))


@query("SELECT paper_id, float_id AS mark_id, CAST(n * 70 * 65536 AS BIGINT) AS hsize_sp, CAST((n * 60 + 0.5) * 65536 AS BIGINT) AS linewidth_sp, CAST(240 * 65536 AS BIGINT) AS columnwidth_sp FROM floats", "floats")
def log_mark_parse(spark, d):
    return typeset.marks(_log(spark, d))


@query(
    """SELECT DISTINCT paper_id, CAST(round_even(614.295::DOUBLE * 65536, 0) AS BIGINT) AS paperwidth_sp, CAST((paper_id % 100 + 700.5) * 65536 AS BIGINT) AS paperheight_sp, CAST(430 * 65536 AS BIGINT) AS textwidth_sp, CAST(0 AS BIGINT) AS textheight_sp,
    CAST(-12.25 * 65536 AS BIGINT) AS oddsidemargin_sp, CAST(655360 AS BIGINT) AS topmargin_sp, CAST(0 AS BIGINT) AS headheight_sp, CAST(0 AS BIGINT) AS headsep_sp, CAST(0 AS BIGINT) AS columnwidth_sp, CAST(0 AS BIGINT) AS columnsep_sp FROM floats""",
    "floats",
)
def pageinfo_parse(spark, d):
    return typeset.page_info(_log(spark, d))


def _resolve_input(spark, d) -> dict[str, DataFrame]:
    """Relations for the resolver straight from the floats: wraps for bodies with n < 3, spans otherwise."""
    f = A.floats(spark, d, dealt=True).withColumn("ord", F.xxhash64("float_id"))
    wrap = F.col("n") < 3
    names = lambda *s: F.array(*[F.concat("float_id", F.lit(x)) for x in s])
    manifest = f.select(
        "paper_id", "ord", F.col("float_id").alias("label_id"), F.when(F.col("dx") > 0, F.concat("family", F.lit("_cap"))).otherwise(F.col("family")).alias("kind"),
        F.concat_ws("_", "paper_id", "page").alias("float_id"),
        F.when(wrap, names("-preL", "-postR")).otherwise(names("-no-top", "-no-bot", "-preL", "-end")).alias("anchor_names"),
        F.when(wrap, "wrap").otherwise("span").alias("method"), (F.col("x") == 200).alias("use_textblock_x"),
    )
    sp = lambda v: (v * 65536).cast("bigint")
    anchor = lambda name, x, y, p: F.struct(name.alias("name"), sp(x).alias("posx_sp"), sp(y).alias("posy_sp"), p.cast("bigint").alias("abspage"))
    own = lambda s: F.concat("float_id", F.lit(s))
    x, y, page = F.col("x"), F.col("y"), F.col("page")
    four = F.array(
        anchor(own("-preL"), x, y + 200, page), anchor(own("-postR"), x + 300 + F.col("dx"), y + 200, page), anchor(own("-end"), x, y + 20, page + y % 3 - 1),
        anchor(F.concat(F.lit("alx@cap@bot@"), "float_id"), F.lit(0), y - 50, page),
    )
    anchors = f.select("paper_id", F.explode(four).alias("a")).select("paper_id", "a.*")
    boxes = f.select("paper_id", F.col("float_id").alias("box_id"), sp(F.lit(300)).alias("width_sp"), sp(F.lit(150)).alias("height_sp"), sp(F.lit(10)).alias("depth_sp"), F.lit(0).alias("hsize_sp"))
    marks = f.filter("y % 2 = 0").select("paper_id", F.concat("float_id", F.lit("-preL")).alias("mark_id"), sp(F.lit(250)).alias("hsize_sp"))
    papers = A.floats(spark, d).select("paper_id").distinct()
    info = papers.select("paper_id", *[sp(F.lit(v)).alias(f"{n}_sp") for n, v in zip(typeset.PAGE_FIELDS, (600, 1200, 430, 1000, -10, 5, 12, 20, 210, 10), strict=True)])
    pages = papers.select("paper_id", F.explode(F.sequence(F.lit(1), F.lit(8))).alias("page")).withColumns({"width_pt": F.lit(640.0), "height_pt": F.lit(1250.0)})
    return {"manifest": manifest, "anchors": anchors, "boxes": boxes, "marks": marks, "page_info": info, "pages": pages}


_K = f"{65536 / G.SP_PER_PT!r}::DOUBLE"  # PDF points of a TeX point
_BLOCK = f"(72.0 + -10 * {_K})", f"(72.0 + -10 * {_K} + 430 * {_K})", f"(72.0 + 37 * {_K})", f"(72.0 + 37 * {_K} + 1000 * {_K})"
_CAP = "CASE WHEN dx > 0 THEN family || '_cap' ELSE family END"
_WRAP = f"""wraps AS (SELECT paper_id, page, float_id AS label_id, {_CAP} AS kind, paper_id || '_' || page AS fl, x * {_K} AS x0, 1250.0 - (y + 200) * {_K} - 150 * {_K} AS y0,
    CASE WHEN abs((300 + dx) * {_K} - 300 * {_K}) / (300 * {_K}) > 0.05 THEN x * {_K} + 300 * {_K} ELSE (x + 300 + dx) * {_K} END AS x1, 1250.0 - (y + 200) * {_K} + 10 * {_K} AS y1 FROM floats WHERE n < 3 AND page BETWEEN 1 AND 8)"""
_SPAN = f"""sp0 AS (SELECT *, page AS tp, page + y % 3 - 1 AS bp, unnest(range(least(page, page + y % 3 - 1), greatest(page, page + y % 3 - 1) + 1)) AS pg FROM floats WHERE n = 3),
    spans AS (SELECT paper_id, pg AS page, float_id AS label_id, {_CAP} AS kind, paper_id || '_' || page AS fl, CASE WHEN x = 200 OR tp <> bp THEN {_BLOCK[0]} ELSE x * {_K} END AS x0,
      CASE WHEN pg = tp AND pg = bp THEN 1250.0 - (y + 200) * {_K} WHEN pg = tp THEN 1250.0 - (y + 200) * {_K} ELSE greatest(0.0, {_BLOCK[2]}) END AS y0,
      CASE WHEN x = 200 OR tp <> bp THEN {_BLOCK[1]} WHEN y % 2 = 0 THEN x * {_K} + 250 * {_K} ELSE x * {_K} + 210 * {_K} END AS x1,
      CASE WHEN pg = tp AND pg = bp THEN 1250.0 - (y + 20) * {_K} WHEN pg = tp THEN least({_BLOCK[3]}, 1250.0) WHEN pg = bp THEN 1250.0 - (y + 20) * {_K} ELSE least({_BLOCK[3]}, 1250.0) END AS y1 FROM sp0 WHERE pg BETWEEN 1 AND 8)"""
_ROUND = ", ".join(f"round({v}, 4) AS {v}" for v in ("x0", "y0", "x1", "y1"))


def _boxed(df: DataFrame) -> DataFrame:
    return df.select("paper_id", "label_id", "kind", "page", *[F.round(v, 4).alias(v) for v in ("x0", "y0", "x1", "y1")])


@query(f"WITH {_WRAP} SELECT paper_id, label_id, kind, page, {_ROUND} FROM wraps", "floats")
def wrap_resolve(spark, d):
    r = _resolve_input(spark, d)
    return _boxed(resolve.wraps(r["manifest"], r["anchors"], r["boxes"], r["pages"]))


@query(f"WITH {_SPAN} SELECT paper_id, label_id, kind, page, {_ROUND} FROM spans", "floats")
def span_resolve(spark, d):
    r = _resolve_input(spark, d)
    return _boxed(resolve.spans(r["manifest"], r["anchors"], r["marks"], r["page_info"], r["pages"]))


@query("SELECT paper_id, float_id AS label_id, float_id || '-preL' AS top_name, float_id || '-end' AS bot_name FROM floats WHERE n = 3", "floats")
def fallback_pair_join(spark, d):
    r = _resolve_input(spark, d)
    return resolve.chosen_pairs(r["manifest"], r["anchors"]).select("paper_id", "label_id", "top_name", "bot_name")


_UNION = f"""{_WRAP}, {_SPAN}, resolved AS (SELECT * FROM wraps UNION ALL SELECT * FROM spans),
    wide AS (SELECT r.paper_id, r.label_id, r.kind, r.page, CASE WHEN cap THEN least(r.x0, coalesce(b.x0, r.x0)) ELSE r.x0 END AS x0, CASE WHEN cap THEN least(r.y0, coalesce(b.y0, r.y0), coalesce(e.y, r.y0)) ELSE r.y0 END AS y0,
      CASE WHEN cap THEN greatest(r.x1, coalesce(b.x1, r.x1)) ELSE r.x1 END AS x1, CASE WHEN cap THEN greatest(r.y1, coalesce(b.y1, r.y1), coalesce(e.y, r.y1)) ELSE r.y1 END AS y1
      FROM (SELECT *, kind LIKE '%\\_cap' ESCAPE '\\' AND row_number() OVER (PARTITION BY paper_id, fl, kind LIKE '%\\_cap' ESCAPE '\\' ORDER BY label_id DESC, page DESC) = 1 AS cap FROM resolved) r
      LEFT JOIN (SELECT paper_id, fl, page, min(x0) AS x0, min(y0) AS y0, max(x1) AS x1, max(y1) AS y1 FROM resolved WHERE kind NOT LIKE '%\\_cap' ESCAPE '\\' GROUP BY ALL) b USING (paper_id, fl, page)
      LEFT JOIN (SELECT paper_id, float_id AS label_id, page, 1250.0 - (y - 50) * {_K} AS y FROM floats) e USING (paper_id, label_id, page))"""


def _united(spark, d):
    r = _resolve_input(spark, d)
    r["manifest"] = r["manifest"].withColumn("ord", F.col("label_id"))  # an order that SQL has, too
    lab = resolve.resolve_labels(r["manifest"], r["anchors"], r["boxes"], r["marks"], r["page_info"], r["pages"])
    return resolve.union_with_bodies(lab), r["pages"]


@query(f"WITH {_UNION} SELECT paper_id, label_id, kind, page, {_ROUND} FROM wide", "floats")
def cap_body_union(spark, d):
    return _boxed(_united(spark, d)[0])


_CLIP = _UNION + """, clipped AS (SELECT paper_id, label_id, kind, page, greatest(0.0, least(x0, 640.0)) AS x0, greatest(0.0, least(y0, 1250.0)) AS y0, greatest(0.0, least(x1, 640.0)) AS x1, greatest(0.0, least(y1, 1250.0)) AS y1 FROM wide),
    clean AS (SELECT * FROM clipped WHERE greatest(0.0, x1 - x0) * greatest(0.0, y1 - y0) >= 1.0)"""


@query(f"WITH {_CLIP} SELECT paper_id, label_id, kind, page, {_ROUND} FROM clean", "floats")
def clip_filter(spark, d):
    return _boxed(resolve.cleaned(*_united(spark, d)))


_PX = "(200 / 72.0)"
_SIZE = ", ".join([f"round({v}0 * {_PX}, 3) AS {v}" for v in "xy"] + [f"round(greatest(0.0, {v}1 - {v}0) * {_PX}, 3) AS {n}" for v, n in (("x", "w"), ("y", "h"))])


@query(f"WITH {_CLIP} SELECT paper_id, row_number() OVER (PARTITION BY paper_id ORDER BY label_id, page) AS id, page AS image_id, kind, label_id, {_SIZE}, round(greatest(0.0, x1 - x0) * {_PX} * (greatest(0.0, y1 - y0) * {_PX}), 1) AS area FROM clean", "floats")
def coco_annotations(spark, d):
    out = resolve.coco_annotations(resolve.cleaned(*_united(spark, d)))
    return out.select("paper_id", "id", "image_id", "kind", "label_id", *[F.round(v, 3).alias(v) for v in ("x", "y", "w", "h")], F.round("area", 1).alias("area"))


@query(f"WITH {_CLIP}, k AS (SELECT DISTINCT paper_id, kind FROM clean) SELECT paper_id, row_number() OVER (PARTITION BY paper_id ORDER BY kind) - 1 AS category_id, kind AS name FROM k", "floats")
def coco_categories(spark, d):
    return resolve.coco_categories(resolve.cleaned(*_united(spark, d)))


# fingerprints and checks --------------------------------------------------------------------------


def _labelled(spark, d):
    return A.annotations(spark, d).withColumn("label_id", F.concat_ws("_", "float_id", F.col("i").cast("string"))).withColumn("x", F.col("x") + F.lit(0.5))


@query(
    """WITH l AS (SELECT paper_id, page, kind, float_id || '_' || i AS label_id, CAST(round_even(x + 0.5, 0) AS INT) AS x, CAST(y AS INT) AS y, CAST(w AS INT) AS w, CAST(h AS INT) AS h FROM annotations)
    SELECT p.paper_id, 9 AS num_pages, sha256(string_agg(page || '|' || kind || '|' || label_id || '|' || x || ',' || y || ',' || w || ',' || h, ';' ORDER BY page, kind, label_id)) AS labels_sha FROM (SELECT DISTINCT paper_id FROM images) p JOIN l USING (paper_id) GROUP BY p.paper_id""",
    "annotations", "images",
)
def coco_fingerprint(spark, d):
    f = golden.fingerprints(_labelled(spark, d), A.images(spark, d))
    text = F.array_join(F.transform("labels", lambda r: F.concat_ws("|", r.page.cast("string"), r.kind, r.label_id, F.array_join(r.bbox.cast("array<string>"), ","))), ";")
    return f.select("paper_id", F.col("num_pages").cast("int").alias("num_pages"), F.sha2(text, 256).alias("labels_sha"))


@query(
    """WITH a AS (SELECT *, float_id || '_' || i AS label_id FROM annotations),
    g AS (SELECT paper_id, page, CASE WHEN x > 900 THEN label_id || 'b' ELSE label_id END AS label_id, CASE WHEN y < 90 THEN 'listing' ELSE kind END AS kind, x + CASE WHEN y > 800 THEN 3 WHEN y > 600 THEN 2 ELSE 0 END AS x FROM a),
    j AS (SELECT coalesce(a.paper_id, g.paper_id) AS paper_id, coalesce(a.page, g.page) AS page, coalesce(a.label_id, g.label_id) AS label_id, a.kind AS ak, g.kind AS gk, a.x AS ax, g.x AS gx FROM a FULL JOIN g ON a.paper_id = g.paper_id AND a.page = g.page AND a.label_id = g.label_id)
    SELECT paper_id, page, label_id, unnest(list_filter([CASE WHEN gk IS NULL THEN 'extra' END, CASE WHEN ak IS NULL THEN 'missing' END, CASE WHEN ak <> gk THEN 'kind' END, CASE WHEN abs(ax - gx) > 2 THEN 'bbox' END], lambda p: p IS NOT NULL)) AS problem FROM j""",
    "annotations",
)
def golden_diff(spark, d):
    """All annotations against all of them with some names, kinds and places changed."""
    a = A.annotations(spark, d).withColumn("label_id", F.concat_ws("_", "float_id", F.col("i").cast("string")))
    g = a.withColumns(
        {
            "label_id": F.concat("label_id", F.when(F.col("x") > 900, "b").otherwise("")), "kind": F.when(F.col("y") < 90, "listing").otherwise(F.col("kind")),
            "x": F.col("x") + F.when(F.col("y") > 800, 3).when(F.col("y") > 600, 2).otherwise(0),
        }
    )
    return golden.label_diff(golden.fingerprint_rows(a), golden.fingerprint_rows(g))


@query(
    """WITH f AS (SELECT paper_id || '_' || page AS stem, row_number() OVER (PARTITION BY paper_id, page ORDER BY float_id) AS line, y % 10 AS cls, x, y % 7 AS k FROM floats)
    SELECT 'train' AS split, stem, CAST(line AS INT) AS line, unnest(list_filter(CASE WHEN k = 0 THEN ['bad row'] WHEN k = 1 THEN ['parse error'] ELSE [CASE WHEN cls > 7 THEN 'class out of range' END, CASE WHEN x > 500 THEN 'coordinate out of range' END] END, lambda p: p IS NOT NULL)) AS problem FROM f""",
    "floats",
)
def label_verify(spark, d):
    f = A.floats(spark, d).select("paper_id", "page", "float_id", (F.col("y") % 10).alias("cls"), "x", (F.col("y") % 7).alias("k"))
    line = F.when(F.col("k") == 0, "1 0.5 0.5 0.5").when(F.col("k") == 1, "1 0.5 word 0.5 0.5").otherwise(F.concat_ws(" ", F.col("cls").cast("string"), F.lit("0.5 0.5"), T.six(F.col("x") / 500), F.lit("1.0")))
    files = f.withColumn("t", line).groupBy("paper_id", "page").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("float_id", "t"))), lambda r: r.t), "\n").alias("text"))
    return golden.verify_labels(files.select(F.lit("train").alias("split"), F.concat_ws("_", "paper_id", "page").alias("stem"), "text"), 8)


# catalog, text, streams ---------------------------------------------------------------------------


@query(
    """WITH r AS (SELECT 'u/abs/' || (o_custkey % 700) AS id, o_orderpriority AS queried_archive, o_orderkey AS arrival FROM orders)
    SELECT split_part(id, '/abs/', 2) AS arxiv_id, arg_min(queried_archive, arrival) AS queried_archive, array_to_string(list(queried_archive ORDER BY arrival), ',') AS also FROM r GROUP BY 1"""
)
def catalog_dedupe(spark, d):
    r = A.table(spark, d, "orders").select(T.id_of_url(F.concat(F.lit("u/abs/"), (F.col("o_custkey") % 700).cast("string"))).alias("arxiv_id"), F.col("o_orderpriority").alias("queried_archive"), F.col("o_orderkey").alias("arrival"))
    return catalog.dedupe(r).select("arxiv_id", "queried_archive", F.array_join("also_in_archives", ",").alias("also"))


@query(
    """WITH c AS (SELECT 'p' || o_orderkey AS arxiv_id, [o_orderpriority || '.' || (o_custkey % 7), 'x'] AS categories, strftime(o_orderdate, '%Y-%m-%d') AS published FROM orders),
    page AS (SELECT * FROM c WHERE len(list_filter(categories, lambda k: k = '2-HIGH' OR starts_with(k, '2-HIGH.'))) > 0 AND try_cast(left(published, 4) AS INT) BETWEEN 1996 AND 1998 ORDER BY published DESC, arxiv_id LIMIT 200 OFFSET 10)
    SELECT arxiv_id, left(published, 4) AS year FROM page WHERE NOT regexp_matches(arxiv_id, '7$')"""
)
def candidate_query(spark, d):
    o = A.table(spark, d, "orders")
    c = o.select(
        F.concat(F.lit("p"), F.col("o_orderkey").cast("string")).alias("arxiv_id"), F.lit("").alias("title"), F.lit("").alias("abs_url"), F.lit("").alias("source_url"), F.lit(None).cast("string").alias("primary_category"),
        F.array(F.concat_ws(".", "o_orderpriority", (F.col("o_custkey") % 7).cast("string")), F.lit("x")).alias("categories"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("published"),
    )
    return catalog.candidates(c, "2-HIGH", 1996, 1998, c.filter(F.col("arxiv_id").endswith("7")), 200, 10).select("arxiv_id", "year")


_STATUS = "CASE WHEN event_type IN ('purchase', 'signup') THEN 'ok' WHEN event_type = 'error' THEN 'failed' ELSE 'fetched' END"


def _events(spark, d):
    e = A.table(spark, d, "events")
    status = F.when(F.col("event_type").isin("purchase", "signup"), "ok").when(F.col("event_type") == "error", "failed").otherwise("fetched")
    return e.select(F.col("user_id").alias("arxiv_id"), "ts", "event_id", status.alias("status"))


@query(f"SELECT user_id AS arxiv_id, arg_max({_STATUS}, (ts, event_id)) AS status FROM events GROUP BY 1")
def state_upsert(spark, d):
    return stream.latest(_events(spark, d), "arxiv_id", "ts", "event_id").select("arxiv_id", "status")


@query(f"WITH s AS (SELECT user_id, arg_max({_STATUS}, (ts, event_id)) AS status FROM events GROUP BY 1) SELECT status, count(*) AS n FROM s GROUP BY 1")
def stream_rollup(spark, d):
    """The same through four batches of upserts, as foreachBatch applies them."""
    e = _events(spark, d).withColumn("seq", F.struct("ts", "event_id"))
    state = spark.createDataFrame([], e.schema)
    for k in range(4):
        lo, hi = f"2024-01-{1 + 8 * k:02d}", f"2024-01-{9 + 8 * k:02d}" if k < 3 else "2100-01-01"
        state = stream.upsert(state, e.filter((F.col("ts") >= F.lit(lo).cast("timestamp_ntz")) & (F.col("ts") < F.lit(hi).cast("timestamp_ntz"))), "arxiv_id", "seq")
    return state.groupBy("status").agg(F.count(F.lit(1)).alias("n"))


from galley.plans import library_queries  # noqa: E402, F401  # registers more
