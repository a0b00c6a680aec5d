"""More registered queries: functions and small operators of the library over the adapter relations, each with its SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from galley import schemas as S
from galley.functions import geometry as G
from galley.functions import text as T
from galley.operators import gates, golden, rollup, tex
from galley.plans import adapters as A
from galley.plans.queries import _ARCH, _PASS, _archives, query
from galley.sources import corpus
from galley.streaming import corpus as stream

# joins --------------------------------------------------------------------------------------------

_KINDS = [k for k in S.CLASSES if not k.startswith("listing")]


def _local_categories(spark, d):
    """Category ids that differ from paper to paper: the index of the class plus the paper's id modulo 5."""
    papers = A.table(spark, d, "lineitem").select(F.col("l_orderkey").alias("paper_id")).distinct()
    names = F.posexplode(F.array(*[F.lit(k) for k in _KINDS])).alias("at", "name")
    return papers.select("paper_id", names).select("paper_id", (F.col("at") + F.col("paper_id") % 5).alias("category_id"), "name")


@query("SELECT paper_id, page, float_id, i, kind FROM annotations", "annotations")
def annotation_categories(spark, d):
    ids = F.create_map(*[x for i, k in enumerate(_KINDS) for x in (F.lit(k), F.lit(i))])
    ann = A.annotations(spark, d).withColumn("category_id", ids[F.col("kind")] + F.col("paper_id") % 5).drop("kind")
    return gates.kinds(ann, _local_categories(spark, d)).select("paper_id", "page", "float_id", "i", "kind")


@query("SELECT i.paper_id || '__page_' || printf('%03d', i.page) AS stem FROM images i WHERE NOT EXISTS (SELECT 1 FROM annotations a WHERE a.paper_id = i.paper_id AND a.page = i.page)", "annotations", "images")
def images_without_labels(spark, d):
    name = T.stem(F.col("paper_id").cast("string"), F.col("page").cast("int")).alias("stem")
    images = A.images(spark, d).select(F.lit("train").alias("split"), name)
    files = A.annotations(spark, d).select(F.lit("train").alias("split"), name).distinct()
    return golden.unlabelled_images(images, files).select("stem")


@query(
    """WITH a AS (SELECT o_orderkey AS paper_id, CASE WHEN o_orderstatus = 'F' THEN ['figure', 'table'] ELSE ['table'] END AS c, o_custkey % 30 AS n FROM orders),
    g AS (SELECT o_orderkey AS paper_id, CASE WHEN o_orderpriority < '3' THEN ['figure', 'table'] ELSE ['table'] END AS c, o_custkey % 30 + CASE WHEN o_totalprice > 200000 THEN 1 ELSE 0 END AS n FROM orders)
    SELECT paper_id, unnest(list_filter([CASE WHEN a.c <> g.c THEN 'categories' END, CASE WHEN a.n <> g.n THEN 'num_pages' END], lambda p: p IS NOT NULL)) AS problem FROM a JOIN g USING (paper_id)"""
)
def golden_header_diff(spark, d):
    o = A.table(spark, d, "orders")
    lists = lambda first: F.when(first, F.array(F.lit("figure"), F.lit("table"))).otherwise(F.array(F.lit("table"))).alias("categories")
    pages = F.col("o_custkey") % 30
    a = o.select(F.col("o_orderkey").alias("paper_id"), lists(F.col("o_orderstatus") == "F"), pages.alias("num_pages"))
    g = o.select(F.col("o_orderkey").alias("paper_id"), lists(F.col("o_orderpriority") < "3"), (pages + F.when(F.col("o_totalprice") > 200000, 1).otherwise(0)).alias("num_pages"))
    return golden.header_diff(a, g)


@query("SELECT 'w_' || arxiv_id AS paper_id, archive FROM papers WHERE status = 'ok'", "papers")
def workspace_archive(spark, d):
    """Workspaces of ok papers; the paper is the last part of a path that may end in slashes."""
    p = A.papers(spark, d).withColumn("workspace", F.when(F.col("status") == "ok", F.concat(F.lit("runs/w_"), F.col("arxiv_id").cast("string"), F.when(F.col("pages_total") > 9, "//").otherwise(""))).otherwise(""))
    return corpus.archive_lookup(p)


@query("SELECT p.arxiv_id, 'w_' || p.arxiv_id AS paper_id FROM papers p WHERE status = 'ok' AND EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey = p.arxiv_id AND l_returnflag = 'A')", "papers")
def annotated_workspaces(spark, d):
    p = A.papers(spark, d).withColumn("workspace", F.concat(F.lit("runs/w_"), F.col("arxiv_id").cast("string")))
    annotated = A.floats(spark, d).filter("family = 'figure'").select(F.concat(F.lit("w_"), F.col("paper_id").cast("string")).alias("paper_id")).distinct()
    return corpus.ok_workspaces(p, annotated).select("arxiv_id", "paper_id")


@query(
    """WITH r AS (SELECT DISTINCT l_orderkey AS paper_id, CASE WHEN l_returnflag = 'A' THEN 0 WHEN l_returnflag = 'N' THEN 1 ELSE 2 END AS root FROM lineitem)
    SELECT paper_id, min(root) AS root FROM r GROUP BY 1"""
)
def first_of_roots(spark, d):
    """Papers in up to three roots; of each the first root's rows."""
    f = A.floats(spark, d)
    roots = [f.filter(F.col("family") == k).select("paper_id").distinct().withColumn("root", F.lit(i)) for i, k in enumerate(("figure", "table", "algorithm"))]
    return corpus.first_root(roots).select("paper_id", "root")


@query("SELECT DISTINCT user_id AS arxiv_id FROM events WHERE event_type = 'purchase' AND user_id NOT IN (SELECT user_id FROM events WHERE event_type = 'error' AND value > 95)")
def unseen_candidates(spark, d):
    e = A.table(spark, d, "events").select(F.col("user_id").alias("arxiv_id"), "event_type", "value")
    return stream.unseen(e.filter("event_type = 'purchase'").select("arxiv_id"), e.filter("event_type = 'error' and value > 95").select("arxiv_id"))


# rollups ------------------------------------------------------------------------------------------


@query("SELECT count(*) AS papers, count(*) FILTER (status = 'ok') AS papers_ok, CAST(coalesce(sum(labels_total) FILTER (status = 'ok'), 0) AS BIGINT) AS labels FROM papers", "papers")
def run_totals(spark, d):
    return rollup.run_summary(A.papers(spark, d).select(F.col("arxiv_id").alias("paper_id"), (F.col("status") == "ok").alias("ok"), F.col("labels_total").alias("labels")))


@query(f"WITH {_PASS}, n AS (SELECT subset, count(*) AS p FROM good GROUP BY 1) SELECT (SELECT p FROM n WHERE subset = '8') <= (SELECT p FROM n WHERE subset = '6') AND (SELECT p FROM n WHERE subset = '6') <= (SELECT p FROM n WHERE subset = '4') AS monotone", "annotations", "images", "subsets")
def subsets_grow(spark, d):
    subsets = gates.subset_table(A.annotations(spark, d), A.images(spark, d))
    return rollup.health(A.papers(spark, d), _archives(spark), subsets).select("monotone")


@query(
    f"""WITH n AS (SELECT CAST(sum(n_figure) AS DOUBLE) AS f, CAST(sum(n_table) AS DOUBLE) AS t, CAST(sum(n_algorithm) AS DOUBLE) AS a FROM papers WHERE status = 'ok'),
    s AS (SELECT kind, r FROM (SELECT 'algorithm' AS kind, f / greatest(1, a) AS r, f FROM n UNION ALL SELECT 'table', f / greatest(1, t), f FROM n) WHERE f > 0 AND r > 4 ORDER BY r DESC, kind LIMIT 1),
    u AS (SELECT list(archive ORDER BY archive) AS idle FROM {_ARCH} WHERE archive NOT IN (SELECT archive FROM papers WHERE status = 'ok'))
    SELECT CASE WHEN kind IS NOT NULL THEN 'label_balance' WHEN len(idle) > 0 THEN 'untouched' ELSE 'none' END AS rule, kind, CASE kind WHEN 'algorithm' THEN 'cs' WHEN 'table' THEN 'stat,econ,q-fin,q-bio,eess' ELSE array_to_string(coalesce(idle, []), ',') END AS archives
    FROM u LEFT JOIN s ON true""",
    "papers",
)
def what_next(spark, d):
    p = A.papers(spark, d)
    out = rollup.recommendation(rollup.starving_kinds(rollup.merged_map(p)), {}, rollup.untouched(p, _archives(spark)))
    return out.select("rule", "kind", F.array_join("archives", ",").alias("archives"))


@query(
    """WITH f AS (SELECT paper_id || '_' || page AS stem, y % 10 AS cls, x, y % 7 AS k FROM floats),
    l AS (SELECT unnest(list_filter(CASE WHEN k = 0 THEN ['bad row'] WHEN k = 1 THEN ['parse error'] ELSE [CASE WHEN cls > 7 THEN 'class out of range' END, CASE WHEN x > 500 THEN 'coordinate out of range' END] END, lambda p: p IS NOT NULL)) AS problem FROM f),
    m AS (SELECT 'missing label' AS problem FROM images i WHERE NOT EXISTS (SELECT 1 FROM floats f WHERE f.paper_id = i.paper_id AND f.page = i.page))
    SELECT problem, count(*) AS n FROM (SELECT * FROM l UNION ALL SELECT * FROM m) GROUP BY 1 UNION ALL SELECT 'images', count(*) FROM images""",
    "floats", "images",
)
def verify_counts(spark, d):
    f = A.floats(spark, d).select("paper_id", "page", "float_id", (F.col("y") % 10).alias("cls"), "x", (F.col("y") % 7).alias("k"))
    line = F.when(F.col("k") == 0, "1 0.5 0.5 0.5").when(F.col("k") == 1, "1 0.5 word 0.5 0.5").otherwise(F.concat_ws(" ", F.col("cls").cast("string"), F.lit("0.5 0.5"), T.six(F.col("x") / 500), F.lit("1.0")))
    files = f.withColumn("t", line).groupBy("paper_id", "page").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("float_id", "t"))), lambda r: r.t), "\n").alias("text"))
    stem = F.concat_ws("_", "paper_id", "page").alias("stem")
    images = A.images(spark, d).select(F.lit("train").alias("split"), stem)
    return golden.verify_counts(images, files.select(F.lit("train").alias("split"), stem, "text"), 8)


# functions ----------------------------------------------------------------------------------------

_SCALE = "least(p_size * 40, p_size % 7 * 300 + 100)"


@query(
    f"""SELECT p_partkey AS id, CAST(greatest(1, round_even(p_size * 40 * k, 0)) AS INT) AS w, CAST(greatest(1, round_even((p_size % 7 * 300 + 100) * k, 0)) AS INT) AS h
    FROM (SELECT *, CASE WHEN {_SCALE} > 320 THEN 320.0::DOUBLE / {_SCALE} ELSE 1.0::DOUBLE END AS k FROM part)"""
)
def resized_images(spark, d):
    p = A.table(spark, d, "part")
    w, h = G.resized(F.col("p_size") * 40, F.col("p_size") % 7 * 300 + 100, 320)
    return p.select(F.col("p_partkey").alias("id"), w.alias("w"), h.alias("h"))


@query("SELECT DISTINCT year(o_orderdate) AS lo, 'submittedDate:[' || year(o_orderdate) || '01010000 TO ' || (year(o_orderdate) + o_orderkey % 3) || '12312359]' AS q FROM orders")
def date_ranges(spark, d):
    y = F.year("o_orderdate")
    return A.table(spark, d, "orders").select(y.cast("bigint").alias("lo"), T.date_range(y, (y + F.col("o_orderkey") % 3).cast("int")).alias("q")).distinct()


@query("SELECT o_orderkey AS id, format('{:,}', CAST(o_custkey AS BIGINT) * 12345 - 500000) AS n FROM orders")
def thousands(spark, d):
    return A.table(spark, d, "orders").select(F.col("o_orderkey").alias("id"), T.thousands(F.col("o_custkey").cast("bigint") * 12345 - 500000).alias("n"))


@query(
    """SELECT p_partkey AS id, CASE WHEN p_type = 'LARGE' THEN 'xelatex,lualatex,pdflatex' WHEN p_type = 'MEDIUM' THEN 'lualatex,xelatex,pdflatex' WHEN p_type = 'ECONOMY' THEN 'lualatex,pdflatex,xelatex' ELSE 'pdflatex,xelatex,lualatex' END AS engines FROM part"""
)
def engine_order(spark, d):
    box = F.col("p_type")
    text = F.when(box == "LARGE", "\\usepackage{FontSpec}").when(box == "MEDIUM", "\\usepackage{luacode}").otherwise("\\usepackage{amsmath}")
    hint = F.when(box == "ECONOMY", "lualatex").when(box == "SMALL", "othertex")
    p = A.table(spark, d, "part").select("p_partkey", T.engines(text, hint).alias("hinted"), T.engines(text).alias("plain"))
    return p.select(F.col("p_partkey").alias("id"), F.array_join(F.coalesce("hinted", "plain"), ",").alias("engines"))


@query(
    """WITH t AS (SELECT p_partkey AS id, CASE p_size % 4 WHEN 0 THEN 'src/main.tex' WHEN 1 THEN 'ms.tex' WHEN 2 THEN 'a/b/Template.tex' ELSE 'paper_appendix.tex' END AS path,
      p_name || CASE WHEN p_size > 5 THEN '\\documentclass{a}' ELSE '' END || CASE WHEN p_size < 45 THEN '\\begin{document}' ELSE '' END AS text, p_size FROM part)
    SELECT id, CASE WHEN p_size > 5 AND p_size < 45 THEN strlen(text) + CASE p_size % 4 WHEN 0 THEN 1000 - 50 WHEN 1 THEN 800 - 25 WHEN 2 THEN -75 - 400 ELSE -25 - 400 END END AS score FROM t"""
)
def main_file_scores(spark, d):
    k = F.col("p_size") % 4
    path = F.when(k == 0, "src/main.tex").when(k == 1, "ms.tex").when(k == 2, "a/b/Template.tex").otherwise("paper_appendix.tex")
    text = F.concat("p_name", F.when(F.col("p_size") > 5, "\\documentclass{a}").otherwise(""), F.when(F.col("p_size") < 45, "\\begin{document}").otherwise(""))
    p = A.table(spark, d, "part").select("p_partkey", path.alias("path"), text.alias("text"))
    return p.select(F.col("p_partkey").alias("id"), T.main_file_score(F.col("path"), F.col("text"), F.octet_length("text")).cast("bigint").alias("score"))


@query(
    """SELECT paper_id, float_id, CASE WHEN n = 1 THEN NULL ELSE y % 10 END AS cls, x / 600.0::DOUBLE AS cx, CASE WHEN n = 2 THEN NULL ELSE 0.25::DOUBLE END AS cy, 0.5::DOUBLE AS nw, CASE WHEN n = 3 THEN NULL ELSE 1.0::DOUBLE END AS nh
    FROM (SELECT * REPLACE (CAST(round(x / 600.0::DOUBLE, 6) * 600.0 AS DOUBLE) AS x) FROM floats)""",
    "floats",
)
def label_lines(spark, d):
    """Lines with a class, a number or a field that isn't there."""
    f = A.floats(spark, d)
    line = F.concat_ws("  ", F.when(F.col("n") == 1, "word").otherwise((F.col("y") % 10).cast("string")), T.six(F.col("x") / 600.0), F.when(F.col("n") == 2, "x.5").otherwise("0.25"), F.lit("0.5"), F.when(F.col("n") < 3, "1.0"))
    return f.select("paper_id", "float_id", T.parse_yolo(F.concat(F.lit(" "), line, F.lit(" "))).alias("v")).select("paper_id", "float_id", "v.cls", F.round("v.cx", 6).alias("cx"), "v.cy", "v.nw", "v.nh")


_PT = f"{65536 / G.SP_PER_PT!r}::DOUBLE"


@query(
    f"""SELECT DISTINCT l_linenumber AS line, CAST(l_quantity AS INT) AS q, round(CASE WHEN l_linenumber > 2 AND l_quantity > 9 THEN (l_quantity * 10)::DOUBLE / (l_linenumber * 100 - 200) ELSE 1.0 END, 6) AS columns,
    round(72.0 - l_linenumber * {_PT}, 6) AS text_left, round(72.0 - l_linenumber * {_PT} + CASE WHEN l_quantity > 9 THEN l_quantity * 10 ELSE 0 END * {_PT}, 6) AS text_right FROM lineitem"""
)
def text_blocks(spark, d):
    li = A.table(spark, d, "lineitem").select("l_linenumber", F.col("l_quantity").cast("double").alias("q")).distinct()
    sp = lambda v: (v * 65536).cast("bigint")
    fields = {"oddsidemargin": -F.col("l_linenumber"), "textwidth": F.when(F.col("q") > 9, F.col("q") * 10).otherwise(0), "columnwidth": F.col("l_linenumber") * 100 - 200}
    zero = ("topmargin", "headheight", "headsep", "textheight", "columnsep", "paperwidth", "paperheight")
    info = li.select("l_linenumber", "q", *[sp(v).alias(f"{n}_sp") for n, v in fields.items()], *[F.lit(0).alias(f"{n}_sp") for n in zero])
    t = G.text_block()
    return info.select(F.col("l_linenumber").alias("line"), F.col("q").cast("int").alias("q"), *[F.round(t[k], 6).alias(n) for k, n in (("columns_est", "columns"), ("text_left", "text_left"), ("text_right", "text_right"))])


# TeX ----------------------------------------------------------------------------------------------


def _tex(spark, d):
    """A TeX text for each order: a float a line item, in order of float id."""
    f = A.floats(spark, d).groupBy("paper_id").agg(F.sort_array(F.collect_list(F.struct("float_id", "family"))).alias("floats"))

    def env(family):
        body = F.when(family == "figure", F.lit("\\includegraphics{a}\n\\caption{A}")).when(family == "table", F.lit("\\begin{tabular}{c}1\\end{tabular}")).otherwise(F.lit("\\caption{B}\nstep"))
        return F.concat(F.lit("\\begin{"), family, F.lit("}\n"), body, F.lit("\n\\end{"), family, F.lit("}"))

    return f.select("paper_id", F.array_join(F.transform("floats", lambda r: env(r.family)), "\n").alias("text"))


_RANKED = """r AS (SELECT paper_id, family, float_id AS f, row_number() OVER (PARTITION BY paper_id, family ORDER BY float_id) AS k,
    row_number() OVER (PARTITION BY paper_id ORDER BY CASE family WHEN 'figure' THEN 0 WHEN 'table' THEN 1 ELSE 2 END, float_id) - 1 AS p FROM floats)"""


@query(
    f"""WITH {_RANKED}, n AS (SELECT *, family || '_' || k AS name, family || '_cap_' || k AS cap FROM r)
    SELECT CAST(paper_id AS VARCHAR) AS paper_id, CAST(2 * p AS INT) AS ord, name AS label_id, family AS kind, family || '_float_' || k AS float_id, CASE family WHEN 'algorithm' THEN 'span' ELSE 'wrap' END AS method,
      CASE family WHEN 'algorithm' THEN 'alx@flt@bodytop@' || cap || ',alx@flt@bodybot@' || cap || ',' || name || '-fallback-top,' || name || '-fallback-bot' ELSE name || '-preL,' || name || '-postR' END AS anchors FROM n
    UNION ALL SELECT CAST(paper_id AS VARCHAR), CAST(2 * p + 1 AS INT), cap, family || '_cap', family || '_float_' || k, 'span', 'alx@flt@top@' || cap || ',alx@flt@bot@' || cap || ',' || cap || '-inner-top,' || cap || '-inner-bot,' || cap || '-outer-top,' || cap || '-outer-bot' FROM n""",
    "floats",
)
def tex_instrument(spark, d):
    """Labels that rewriting gives, with running ids of each kind in the order of the passes."""
    return tex.labels(_tex(spark, d)).select("paper_id", "ord", "label_id", "kind", "float_id", "method", F.array_join("anchor_names", ",").alias("anchors"))


@query(
    """SELECT CAST(paper_id AS VARCHAR) AS paper_id, CAST(row_number() OVER (PARTITION BY paper_id ORDER BY float_id) - 1 AS INT) AS ord, family AS name,
    CASE family WHEN 'figure' THEN chr(10) || '\\includegraphics{a}' || chr(10) || '\\caption{A}' || chr(10) WHEN 'table' THEN chr(10) || '\\begin{tabular}{c}1\\end{tabular}' || chr(10) ELSE chr(10) || '\\caption{B}' || chr(10) || 'step' || chr(10) END AS body FROM floats""",
    "floats",
)
def env_scan(spark, d):
    """Float environments with their bodies, by the scanner."""
    return tex.environments(_tex(spark, d), tex.FLOATS).select("paper_id", "ord", "name", "body")


@query("SELECT paper_id, array_to_string(list_filter([CASE WHEN bool_or(family = 'figure') THEN 'figure' END, CASE WHEN bool_or(family = 'table') THEN 'table' END, CASE WHEN bool_or(family = 'algorithm') THEN 'algorithm' END], lambda k: k IS NOT NULL), ',') AS names FROM floats GROUP BY 1", "floats")
def environment_names(spark, d):
    return _tex(spark, d).select("paper_id", F.array_join(T.environments(F.col("text"), ("figure", "table", "algorithm", "listing")), ",").alias("names"))


@query(
    """WITH s AS (SELECT CAST(paper_id AS VARCHAR) AS paper_id, string_agg(chr(10) || 'S' || page || chr(10), '' ORDER BY float_id) AS body FROM floats GROUP BY 1)
    SELECT paper_id, 'src/main.tex' AS path, sha256('\\documentclass{a}\\begin{document}' || body || '%\\input{s1}' || chr(10) || '\\input{none}') AS text_sha FROM s""",
    "floats",
)
def tex_flattened(spark, d):
    """Main files with a section for each line item included, some by name alone, some from the root; comments and missing files stay."""
    f = A.floats(spark, d, dealt=True).select("paper_id", "float_id", "page", (F.col("n") == 1).alias("deep"))
    papers = f.groupBy("paper_id").agg(F.sort_array(F.collect_list(F.struct("float_id", "page", "deep"))).alias("floats"))

    def file(path, text):
        return F.struct(path.alias("path"), text.alias("text"))

    def name(r):
        return F.concat(F.lit("s"), r.page.cast("string"))

    def section(r):
        return file(F.concat(F.when(r.deep, F.lit("src/")).otherwise(F.lit("parts/")), name(r), F.lit(".tex")), F.concat(F.lit("S"), r.page.cast("string")))

    def call(r):
        return F.concat(F.lit("\\input{"), F.when(r.deep, name(r)).otherwise(F.concat(F.lit("parts/"), name(r), F.lit(".tex"))), F.lit("}"))

    main = F.concat(F.lit("\\documentclass{a}\\begin{document}"), F.array_join(F.transform("floats", call), ""), F.lit("%\\input{s1}\n\\input{none}"))
    files = papers.select("paper_id", F.inline(F.array_append(F.transform("floats", section), file(F.lit("src/main.tex"), main))))
    return tex.flattened(files).select("paper_id", "path", F.sha2("text", 256).alias("text_sha"))
