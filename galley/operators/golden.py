"""Fingerprints of annotations and their comparison; checks of emitted label files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from galley.functions.dealing import by_paper


def integer_box(*v: Column) -> Column:
    """Pixels rounded to integers, ties to even."""
    return F.array(*[F.rint(x).cast("int") for x in v])


def fingerprint_rows(ann: DataFrame) -> DataFrame:
    """(paper_id, page, kind, label_id, bbox)."""
    return ann.select("paper_id", "page", "kind", "label_id", integer_box(*[F.col(c) for c in ("x", "y", "w", "h")]).alias("bbox"))


def fingerprints(ann: DataFrame, images: DataFrame) -> DataFrame:
    """One row a paper of images: categories (sorted), num_pages, labels sorted by page, kind, label_id."""
    labels = fingerprint_rows(by_paper(ann)).groupBy("paper_id").agg(
        F.sort_array(F.collect_set("kind")).alias("categories"), F.array_sort(F.collect_list(F.struct("page", "kind", "label_id", "bbox"))).alias("labels")
    )
    return images.groupBy("paper_id").agg(F.count(F.lit(1)).alias("num_pages")).join(labels, "paper_id", "left").select(
        "paper_id", F.coalesce("categories", F.array().cast("array<string>")).alias("categories"), "num_pages", "labels"
    )


def close(a: Column, b: Column, tolerance: int = 2) -> Column:
    return (F.size(a) == 4) & (F.size(b) == 4) & F.forall(F.zip_with(a, b, lambda x, y: F.abs(x - y) <= tolerance), lambda ok: F.coalesce(ok, F.lit(False)))


def label_diff(actual: DataFrame, golden: DataFrame, tolerance: int = 2) -> DataFrame:
    """(paper_id, page, label_id, problem) of label rows that don't match: extra, missing, kind, bbox."""
    key = ["paper_id", "page", "label_id"]
    a = by_paper(actual).select(*key, F.col("kind").alias("a_kind"), F.col("bbox").alias("a_box"), F.lit(True).alias("in_a"))
    g = by_paper(golden).select(*key, F.col("kind").alias("g_kind"), F.col("bbox").alias("g_box"), F.lit(True).alias("in_g"))
    j = a.join(g, key, "full_outer")
    problems = F.array_compact(
        F.array(
            F.when(F.col("in_g").isNull(), "extra"), F.when(F.col("in_a").isNull(), "missing"),
            F.when(F.col("in_a") & F.col("in_g") & (F.col("a_kind") != F.col("g_kind")), "kind"),
            F.when(F.col("in_a") & F.col("in_g") & ~close(F.col("a_box"), F.col("g_box"), tolerance), "bbox"),
        )
    )
    return j.select(*key, F.explode(problems).alias("problem"))


def header_diff(actual: DataFrame, golden: DataFrame) -> DataFrame:
    """(paper_id, problem): categories or num_pages that differ."""
    j = actual.select("paper_id", F.col("categories").alias("ac"), F.col("num_pages").alias("an")).join(golden.select("paper_id", F.col("categories").alias("gc"), F.col("num_pages").alias("gn")), "paper_id")
    return j.select("paper_id", F.explode(F.array_compact(F.array(F.when(F.col("ac") != F.col("gc"), "categories"), F.when(F.col("an") != F.col("gn"), "num_pages")))).alias("problem"))


def verify_labels(files: DataFrame, classes: int) -> DataFrame:
    """(split, stem, line, problem) of label files (split, stem, text): number of fields, parse, class range,
    coordinates. An empty file is a valid negative."""
    bare = F.regexp_replace("text", r"^\s+|\s+$", "")
    lines = files.filter(bare != "").select("split", "stem", F.posexplode(F.split(bare, r"\r?\n")).alias("at", "row"))
    parts = F.filter(F.split("row", r"\s+"), lambda p: p != "")
    parsed = lines.withColumn("p", parts).withColumns(
        {"cls": F.get("p", F.lit(0)).try_cast("int"), "v": F.transform(F.slice("p", 2, 4), lambda x: x.try_cast("double"))}
    )
    bad_number = F.col("cls").isNull() | F.exists("v", lambda x: x.isNull())
    fields = F.size("p") != 5
    problems = F.array_compact(
        F.array(
            F.when(fields, "bad row"), F.when(~fields & bad_number, "parse error"),
            F.when(~fields & ~bad_number & ~F.col("cls").between(0, classes - 1), "class out of range"),
            F.when(~fields & ~bad_number & F.exists("v", lambda x: ~x.between(0.0, 1.0)), "coordinate out of range"),
        )
    )
    return parsed.select("split", "stem", (F.col("at") + 1).alias("line"), F.explode(problems).alias("problem"))


def unlabelled_images(images: DataFrame, files: DataFrame) -> DataFrame:
    return images.select("split", "stem").join(files.select("split", "stem"), ["split", "stem"], "left_anti")


def problems(images: DataFrame, files: DataFrame, classes: int) -> DataFrame:
    """(split, stem, line, problem) of label files and of images without one (line 0)."""
    missing = unlabelled_images(images, files).select("split", "stem", F.lit(0).alias("line"), F.lit("missing label").alias("problem"))
    return verify_labels(files, classes).select("split", "stem", "line", "problem").unionByName(missing)


def verify_counts(images: DataFrame, files: DataFrame, classes: int) -> DataFrame:
    """(problem, n), and a row 'images' with their number."""
    all_ = problems(images, files, classes).select("problem").unionByName(images.select(F.lit("images").alias("problem")))
    return all_.groupBy("problem").agg(F.count(F.lit(1)).alias("n"))


def verify_summary(images: DataFrame, files: DataFrame, classes: int, first: int = 20) -> tuple[int, int, list[str]]:
    """Images, issues, and the first messages in order."""
    n = {r.problem: r.n for r in verify_counts(images, files, classes).collect()}  # a row a kind of problem
    shown = problems(images, files, classes).orderBy("split", "stem", "line", "problem").limit(first).collect()
    return n.pop("images", 0), sum(n.values()), [f"{r.split}/{r.stem}:{r.line} {r.problem}" for r in shown]
