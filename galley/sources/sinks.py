"""Sinks: annotation documents, label files, manifests, and the small text artefacts of a dataset."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from galley import schemas as S
from galley.functions.geometry import image_size
from galley.functions.text import utc_now, yolo_line


def coco_documents(ann: DataFrame, categories: DataFrame, images: DataFrame, dpi: int = 200, engine: str | None = None) -> DataFrame:
    """(paper_id, document): one JSON annotation document a paper of images. ann as from resolve.coco_annotations."""
    a = ann.join(categories.withColumnRenamed("name", "kind"), ["paper_id", "kind"]).groupBy("paper_id").agg(
        F.array_sort(F.collect_list(F.struct("id", "image_id", "category_id", F.array("x", "y", "w", "h").alias("bbox"), "area", F.lit(0).alias("iscrowd"), "label_id"))).alias("annotations")
    )
    c = categories.groupBy("paper_id").agg(F.array_sort(F.collect_list(F.struct(F.col("category_id").alias("id"), "name"))).alias("categories"))
    i = images.groupBy("paper_id").agg(F.array_sort(F.collect_list(F.struct(F.col("page").alias("id"), "file_name", "width", "height"))).alias("images"))
    empty = lambda n: F.coalesce(n, F.from_json(F.lit("[]"), S.COCO[n].dataType.simpleString()))
    info = F.struct(F.col("paper_id").cast("string").alias("paper_id"), F.lit(dpi).alias("dpi"), F.lit(engine).alias("engine"))
    j = i.join(c, "paper_id", "left").join(a, "paper_id", "left")
    cast = lambda n: F.col(n).cast(S.COCO[n].dataType).alias(n)
    j = j.select("paper_id", info.alias("info"), cast("categories"), cast("images"), cast("annotations"))
    return j.select("paper_id", F.to_json(F.struct("info", empty("categories").alias("categories"), "images", empty("annotations").alias("annotations"))).alias("document"))


def manifest_documents(manifest: DataFrame) -> DataFrame:
    fields = F.struct("ord", "label_id", "kind", "float_id", "anchor_names", "method", "use_textblock_x")
    lists = manifest.groupBy("paper_id").agg(F.array_sort(F.collect_list(fields)).alias("labels"))
    return lists.select("paper_id", F.to_json(F.struct(F.transform("labels", lambda x: x.dropFields("ord")).alias("labels")), {"ignoreNullFields": "false"}).alias("document"))


def write_documents(docs: DataFrame, path: str, buckets: int = 64) -> None:
    """(paper_id, document) as Parquet, in folders by a hash of the paper: as many as given, however many papers there are."""
    docs.withColumn("bucket", F.pmod(F.xxhash64("paper_id"), F.lit(buckets))).write.mode("overwrite").partitionBy("bucket").parquet(path)


def label_files(pages: DataFrame) -> DataFrame:
    """(split, stem, text): the label file of each page candidate; empty for negatives."""
    lines = F.transform(F.coalesce("rows", F.from_json(F.lit("[]"), "array<struct<ord:bigint,cls:int,cx:double,cy:double,nw:double,nh:double>>")), lambda r: yolo_line(r.cls, r.cx, r.cy, r.nw, r.nh))
    return pages.select("split", "stem", F.array_join(lines, "\n").alias("text"))


def write_labels(files: DataFrame, path: str) -> None:
    """Label texts as Parquet by split directory: dataset tables, not a file for each page."""
    name = F.when(F.col("split") == "val", "valid").otherwise(F.col("split"))
    files.withColumn("dir", name).write.mode("overwrite").partitionBy("dir").parquet(path)


def sha_manifest(files: DataFrame) -> DataFrame:
    """(path, sha256) of binary files (path, content), sorted by path."""
    return files.select("path", F.sha2("content", 256).alias("sha256")).orderBy("path")


def manifest_of(spark: SparkSession, path: str) -> DataFrame:
    """sha_manifest of a directory tree, paths relative to it."""
    root = path.rstrip("/")
    df = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root)
    return sha_manifest(df.select(F.regexp_replace("path", f"^.*{root.rsplit('/', 1)[-1]}/", "").alias("path"), "content"))


def data_yaml(classes: tuple[str, ...]) -> str:
    names = "\n".join(f"  {i}: {c}" for i, c in enumerate(classes))
    return "path: .\n" + "".join(f"{k}: {v}/images\n" for k, v in S.SPLIT_DIRS.items()) + f"nc: {len(classes)}\nnames:\n{names}\n"


def train_yaml(weights: list[tuple[str, int, float]], short_side: int) -> str:
    """A training file from (class, count, weight) rows."""
    options = {"task": "detect", "mode": "train", "data": "data.yaml", "imgsz": image_size(short_side), "epochs": 100, "batch": 16, "fliplr": 0.5, "flipud": 0.0}
    body = [f"{k}: {v}" for k, v in options.items()] + ["cls_weights: [" + ", ".join(str(w) for _, _, w in weights) + "]"]
    return "\n".join(body + [f"# {n}: {k}" for n, k, _ in weights]) + "\n"


def dataset_meta(pages: DataFrame, classes: tuple[str, ...], settings: dict) -> DataFrame:
    """One row (document): provenance, settings and totals of an export."""
    split = pages.groupBy("split").agg(F.count(F.lit(1)).alias("pages"), F.count_if(F.col("n_rows") > 0).alias("positive"))
    splits = split.agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("split", F.struct("pages", "positive"))))).alias("splits"))
    totals = pages.agg(F.count(F.lit(1)).alias("pages"), F.coalesce(F.sum("n_rows"), F.lit(0)).alias("labels"), F.count_distinct("paper_id").alias("papers"))
    both = splits.crossJoin(totals.select(F.struct("*").alias("totals")))  # one row each
    head = {"schema_version": F.lit(1), "created": utc_now(), "classes": F.array(*[F.lit(c) for c in classes]), "settings": F.lit(json.dumps(settings, sort_keys=True))}
    return both.select(F.to_json(F.struct(*[v.alias(k) for k, v in head.items()], "splits", "totals")).alias("document"))


def dataset_card(subset_rows: list[dict], split_rows: list[dict]) -> str:
    """A Markdown card of the subset report and the splits."""

    def table(rows: list[dict]) -> str:
        if not rows:
            return ""
        head = list(rows[0])
        return "\n".join(["| " + " | ".join(head) + " |", "|" + "---|" * len(head), *("| " + " | ".join(str(r[k]) for k in head) + " |" for r in rows)])

    return f"# Dataset\n\n## Subsets\n\n{table(subset_rows)}\n\n## Splits\n\n{table(split_rows)}\n"


def message_card(title: str, lines: list[str], keyword: str = "") -> str:
    """A message document for a webhook; sending it is up to the caller."""
    head = f"{keyword} {title}".strip() if keyword not in title else title
    return json.dumps({"title": head, "elements": [{"tag": "markdown", "content": x} for x in lines]}, ensure_ascii=False)


def golden_documents(fingerprints: DataFrame) -> DataFrame:
    """(paper_id, document) of golden.fingerprints: what corpus.read_golden reads."""
    labels = F.transform(F.coalesce("labels", F.array().cast("array<struct<page:int,kind:string,label_id:string,bbox:array<int>>>")), lambda r: F.struct(r.label_id.alias("label_id"), r.kind.alias("kind"), r.page.alias("page"), r.bbox.alias("bbox")))
    return fingerprints.select("paper_id", F.to_json(F.struct("categories", F.col("num_pages").cast("int").alias("num_pages"), labels.alias("labels"))).alias("document"))


def run_documents(outcomes: DataFrame) -> DataFrame:
    """One row (document): the outcome of each paper of one run, and the totals of its ok papers. A run is a batch of bounded size."""
    good = F.col("ok")
    totals = F.struct(F.count(F.lit(1)).alias("papers"), F.count_if(good).alias("papers_ok"), F.coalesce(F.sum(F.when(good, F.col("labels"))), F.lit(0)).alias("labels"))
    papers = F.array_sort(F.collect_list(F.struct("paper_id", "ok", "reason", "labels")))
    return outcomes.agg(papers.alias("papers"), totals.alias("totals")).select(F.to_json(F.struct("papers", "totals")).alias("document"))
