"""Layout relations derived from the star-schema test tables by deterministic projections, so that every
operator has input of any size whose result SQL can check. SQL holds the same projections for DuckDB."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

PAGE_W, PAGE_H = 1700, 2200


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def floats(spark: SparkSession, sf_dir: str, dealt: bool = False) -> DataFrame:
    """One float a line item: paper, page, float_id, family, position, number of bodies, shift. dealt: the floats of a paper lie in one partition.
    Then the fields travel as one array: nothing is pruned from it, so all relations of a paper share one exchange."""
    item = F.array(
        F.col("l_linenumber").cast("bigint"), "l_partkey", "l_suppkey", F.round(F.col("l_extendedprice") * 100).cast("bigint"), F.col("l_quantity").cast("int").cast("bigint"),
        F.when(F.col("l_returnflag") == "A", 0).when(F.col("l_returnflag") == "N", 1).otherwise(2).cast("bigint"), F.when(F.col("l_discount") >= 0.095, 700).otherwise(0).cast("bigint"),
    )
    items = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("paper_id"), item.alias("item"))
    items = items.repartition("paper_id") if dealt else items
    line, part, supp, cents, quantity, family, dx = (F.get("item", F.lit(i)) for i in range(7))
    return items.select(
        "paper_id",
        line.cast("int").alias("page"),
        F.concat_ws("_", "paper_id", line, part, supp, cents).alias("float_id"),
        F.when(family == 0, "figure").when(family == 1, "table").otherwise("algorithm").alias("family"),
        (quantity.cast("int") * 20).alias("x"),
        (part % 1000).cast("int").alias("y"),
        (line.cast("int") % 3 + 1).alias("n"),
        dx.cast("int").alias("dx"),
    )


def annotations(spark: SparkSession, sf_dir: str, dealt: bool = True) -> DataFrame:
    """paper_id, page, float_id, kind, x, y, w, h (doubles), i: a caption (i = 0) and its bodies for each float."""
    box = F.explode(F.sequence(F.lit(0), F.col("n")))
    f = floats(spark, sf_dir, dealt).withColumn("i", box)
    cap = F.col("i") == 0
    return f.select(
        "paper_id", "page", "float_id", "i",
        F.when(cap, F.concat("family", F.lit("_cap"))).otherwise(F.col("family")).alias("kind"),
        F.when(cap, F.col("x")).otherwise(F.col("x") + F.col("dx") + 10 + 190 * (F.col("i") - 1)).cast("double").alias("x"),
        F.when(cap, F.col("y")).otherwise(F.col("y") + 10).cast("double").alias("y"),
        F.when(cap, 600).otherwise(180).cast("double").alias("w"),
        F.when(cap, 400).otherwise(300).cast("double").alias("h"),
    )


def images(spark: SparkSession, sf_dir: str) -> DataFrame:
    """paper_id, page, width, height: nine pages for each paper that has floats."""
    papers = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("paper_id")).distinct()
    return papers.select("paper_id", F.explode(F.sequence(F.lit(1), F.lit(9))).alias("page")).withColumns(
        {"width": F.lit(PAGE_W), "height": F.when(F.col("paper_id") % 5 == 0, PAGE_W).otherwise(PAGE_H)}
    )


def papers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Corpus records from orders."""
    status = F.when(F.col("o_orderstatus") == "F", "ok").when(F.col("o_orderstatus") == "O", "failed").otherwise("queued")
    k = F.col("o_custkey") % 4
    reason = F.when(k == 0, "").when(k == 1, "compile failed (None)").when(k == 2, "no PAGEINFO in log").otherwise("no main tex found")
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("arxiv_id"),
        F.col("o_orderpriority").alias("archive"),
        F.when(F.col("o_custkey") % 11 != 0, F.concat("o_orderpriority", F.lit("."), (F.col("o_custkey") % 7).cast("string"))).alias("primary_category"),
        F.when(F.col("o_custkey") % 13 != 0, F.year("o_orderdate").cast("string")).otherwise("").alias("year"),
        status.alias("status"),
        F.when(status == "failed", reason).otherwise("").alias("reason"),
        (F.col("o_custkey") % 30 + 1).alias("pages_total"),
        (F.col("o_custkey") % 7).alias("pages_with_labels"),
        (F.col("o_custkey") % 17).alias("labels_total"),
        F.create_map(
            F.lit("figure"), F.col("o_custkey") % 5, F.lit("table"), F.col("o_custkey") % 3, F.lit("algorithm"), (F.col("o_custkey") % 50 == 0).cast("bigint")
        ).alias("labels_by_kind"),
    )


def samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sample pages from documents and labels: stem, archive, split_key, cls (classes; empty: a negative page)."""
    d, lab = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    lab = lab.groupBy("doc_id").agg(F.max("quality").alias("quality"), F.max("toxic").alias("toxic"))
    cls = F.when(F.col("quality").isNull(), F.array().cast("array<int>")).otherwise(F.array(F.col("quality").cast("int"), (F.col("toxic") + 2).cast("int"), (F.col("doc_id") % 4 + 4).cast("int")))
    return d.select("doc_id", "source").join(lab, "doc_id", "left").select(F.concat(F.lit("doc_"), F.col("doc_id").cast("string")).alias("stem"), F.col("source").alias("archive"), cls.alias("cls"))


SQL = {
    "floats": """SELECT l_orderkey AS paper_id, l_linenumber AS page, l_orderkey || '_' || l_linenumber || '_' || l_partkey || '_' || l_suppkey || '_' || CAST(round(l_extendedprice * 100) AS BIGINT) AS float_id,
        CASE l_returnflag WHEN 'A' THEN 'figure' WHEN 'N' THEN 'table' ELSE 'algorithm' END AS family,
        CAST(trunc(l_quantity) AS INT) * 20 AS x, CAST(l_partkey % 1000 AS INT) AS y, l_linenumber % 3 + 1 AS n, CASE WHEN l_discount >= 0.095 THEN 700 ELSE 0 END AS dx FROM lineitem""",
    "annotations": """SELECT paper_id, page, float_id, i, CASE WHEN i = 0 THEN family || '_cap' ELSE family END AS kind,
        CAST(CASE WHEN i = 0 THEN x ELSE x + dx + 10 + 190 * (i - 1) END AS DOUBLE) AS x, CAST(CASE WHEN i = 0 THEN y ELSE y + 10 END AS DOUBLE) AS y,
        CASE WHEN i = 0 THEN 600.0 ELSE 180.0 END::DOUBLE AS w, CASE WHEN i = 0 THEN 400.0 ELSE 300.0 END::DOUBLE AS h
        FROM (SELECT *, unnest(range(0, n + 1)) AS i FROM floats)""",
    "images": f"""SELECT paper_id, unnest(range(1, 10)) AS page, {PAGE_W} AS width, CASE WHEN paper_id % 5 = 0 THEN {PAGE_W} ELSE {PAGE_H} END AS height
        FROM (SELECT DISTINCT l_orderkey AS paper_id FROM lineitem)""",
    "papers": """SELECT o_orderkey AS arxiv_id, o_orderpriority AS archive, CASE WHEN o_custkey % 11 <> 0 THEN o_orderpriority || '.' || (o_custkey % 7) END AS primary_category,
        CASE WHEN o_custkey % 13 <> 0 THEN CAST(year(o_orderdate) AS VARCHAR) ELSE '' END AS year,
        CASE o_orderstatus WHEN 'F' THEN 'ok' WHEN 'O' THEN 'failed' ELSE 'queued' END AS status,
        CASE WHEN o_orderstatus <> 'O' THEN '' WHEN o_custkey % 4 = 0 THEN '' WHEN o_custkey % 4 = 1 THEN 'compile failed (None)' WHEN o_custkey % 4 = 2 THEN 'no PAGEINFO in log' ELSE 'no main tex found' END AS reason,
        o_custkey % 30 + 1 AS pages_total, o_custkey % 7 AS pages_with_labels, o_custkey % 17 AS labels_total,
        o_custkey % 5 AS n_figure, o_custkey % 3 AS n_table, CASE WHEN o_custkey % 50 = 0 THEN 1 ELSE 0 END AS n_algorithm FROM orders""",
    "samples": """SELECT 'doc_' || d.doc_id AS stem, d.source AS archive, CASE WHEN l.quality IS NULL THEN [] ELSE [l.quality, l.toxic + 2, CAST(d.doc_id % 4 + 4 AS INT)] END AS cls
        FROM documents d LEFT JOIN (SELECT doc_id, max(quality) AS quality, max(toxic) AS toxic FROM labels GROUP BY doc_id) l USING (doc_id)""",
    "subsets": "SELECT * FROM (VALUES ('8','figure'),('8','table'),('8','algorithm'),('8','listing'),('6','figure'),('6','table'),('6','algorithm'),('4','figure'),('4','table')) t(subset, family)",
}


def with_sql(body: str, *names: str) -> str:
    """A query over the adapters named, in order of need."""
    need = [n for n in ("floats", "annotations", "images", "papers", "samples", "subsets") if n in names or (n == "floats" and "annotations" in names)]
    lead = ", ".join(f"{n} AS ({SQL[n]})" for n in need)
    body = body.strip()
    if body[:5].upper() == "WITH ":
        return f"WITH {lead}, {body[5:]}"
    return f"WITH {lead} {body}"
