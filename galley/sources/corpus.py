"""Scans of annotations, state, control and golden files, by Spark's readers only."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from galley import schemas as S

STATE_VERSION = 1


def _path_part(depth: int):
    return F.element_at(F.split(F.col("_metadata.file_path"), "/"), depth)


def read_coco(spark: SparkSession, path: str) -> DataFrame:
    """One row an annotations.json (``path`` may be a glob like root/*/dataset/annotations.json): paper_id from
    the workspace folder, and the document. Corrupt files are left out."""
    schema = S.COCO.add("_corrupt_record", "string")
    df = spark.read.schema(schema).option("multiLine", True).option("mode", "PERMISSIVE").json(path).withColumn("paper_id", _path_part(-3))
    return df.filter("_corrupt_record is null and images is not null").drop("_corrupt_record")


def categories(coco: DataFrame) -> DataFrame:
    return coco.select("paper_id", F.explode("categories").alias("c")).select("paper_id", F.col("c.id").alias("category_id"), "c.name")


def images(coco: DataFrame) -> DataFrame:
    return coco.select("paper_id", F.explode("images").alias("i")).select("paper_id", F.col("i.id").alias("page"), "i.file_name", "i.width", "i.height")


def annotations(coco: DataFrame) -> DataFrame:
    """paper_id, page, ord, label_id, category_id, x, y, w, h. Join with categories for the kind (gates.kinds)."""
    a = coco.select("paper_id", F.posexplode("annotations").alias("ord", "a"))
    box = {n: F.get("a.bbox", F.lit(i)).alias(n) for i, n in enumerate(("x", "y", "w", "h"))}
    return a.select("paper_id", F.col("a.image_id").alias("page"), "ord", "a.label_id", "a.category_id", *box.values())


def existing_pages(spark: SparkSession, glob: str) -> DataFrame:
    """(paper_id, file_name) of page images, by listing alone: root/*/pages/*."""
    files = spark.read.format("binaryFile").load(glob).select("path")
    parts = F.split("path", "/")
    return files.select(F.element_at(parts, -3).alias("paper_id"), F.element_at(parts, -1).alias("file_name"))


def include(df: DataFrame, papers: list[str] | None = None, limit: int = 0) -> DataFrame:
    """Only the papers named, and of those the first ``limit`` by id (a stated option; 0: all)."""
    out = df.filter(F.col("paper_id").isin(papers)) if papers else df
    return out.orderBy("paper_id").limit(limit) if limit > 0 else out


def read_state(spark: SparkSession, path: str) -> DataFrame:
    """Papers of a state document. Fields that older documents lack get their defaults; another version raises."""
    doc = spark.read.schema(S.STATE).option("multiLine", True).json(path)
    checked = doc.withColumn("papers", F.when(F.col("version") == STATE_VERSION, F.col("papers")).otherwise(F.raise_error(F.concat(F.lit("unsupported state version "), F.coalesce(F.col("version").cast("string"), F.lit("none")))).cast(S.STATE["papers"].dataType)))
    p = checked.select(F.explode("papers").alias("id", "p")).select("p.*")
    blank = {"status": "queued", "title": "", "abs_url": "", "source_url": "", "reason": "", "started_at": "", "finished_at": "", "workspace": ""}
    filled = {k: F.coalesce(k, F.lit(v)) for k, v in blank.items()} | {k: F.coalesce(k, F.lit(0)) for k in ("pages_total", "pages_with_labels", "labels_total")}
    filled |= {k: F.coalesce(k, F.create_map().cast(S.PAPER[k].dataType)) for k in ("labels_by_kind", "box_counts_histogram", "spatial_pair_ok")}
    filled["categories"] = F.coalesce("categories", F.array().cast("array<string>"))
    return p.withColumns(filled)


def archive_lookup(papers: DataFrame) -> DataFrame:
    """(paper_id, archive): the paper is the last part of the workspace path."""
    return papers.filter("workspace <> ''").select(F.element_at(F.split(F.regexp_replace("workspace", "/+$", ""), "/"), -1).alias("paper_id"), "archive")


def ok_workspaces(papers: DataFrame, annotated: DataFrame) -> DataFrame:
    """Ok papers with a workspace that has annotations. annotated: paper_id."""
    slug = F.element_at(F.split(F.regexp_replace("workspace", "/+$", ""), "/"), -1)
    return papers.filter("status = 'ok' and workspace <> ''").withColumn("paper_id", slug).join(annotated.select("paper_id"), "paper_id", "left_semi")


def read_control(spark: SparkSession, path: str) -> dict:
    """The control document; {} if it is missing, malformed, or no object."""
    try:
        text = "\n".join(r.value for r in spark.read.text(path).collect())  # a file written by hand
        found = json.loads(text)
    except Exception:
        return {}
    return found if isinstance(found, dict) else {}


def read_golden(spark: SparkSession, path: str) -> DataFrame:
    """Golden fingerprints; the paper is the file's stem."""
    return spark.read.schema(S.GOLDEN).option("multiLine", True).json(path).withColumn("paper_id", F.regexp_replace(_path_part(-1), r"\.json$", ""))


def golden_labels(golden: DataFrame) -> DataFrame:
    return golden.select("paper_id", F.explode("labels").alias("l")).select("paper_id", "l.page", "l.kind", "l.label_id", "l.bbox")


def golden_boxes(golden: DataFrame) -> DataFrame:
    """Golden labels as annotations: x, y, w, h."""
    return golden_labels(golden).select("paper_id", "page", "kind", "label_id", *[F.get("bbox", F.lit(i)).cast("double").alias(n) for i, n in enumerate(("x", "y", "w", "h"))])


def golden_pages(golden: DataFrame) -> DataFrame:
    return golden.select("paper_id", F.explode(F.sequence(F.lit(1), F.col("num_pages"))).alias("page"))


def first_root(tables: list[DataFrame]) -> DataFrame:
    """Rows of the first table (in order) that has a paper: the lookup over ordered roots."""
    out = None
    for k, t in enumerate(tables):
        t = t.withColumn("_root", F.lit(k))
        out = t if out is None else out.unionByName(t)
    least = out.groupBy("paper_id").agg(F.min("_root").alias("_root"))
    return out.join(least, ["paper_id", "_root"]).drop("_root")
