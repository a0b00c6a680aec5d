"""Distributions of labels and pages."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ASPECT = (0.2, 20.0, 39)


def _bin(v, n: int):
    """Bin of v in n equal bins of [0, 1], the last closed on the right."""
    return F.least(F.floor(v * n), F.lit(n - 1)).cast("int")


def center_2d(rows: DataFrame, bins: int = 30) -> DataFrame:
    """(cls, bx, by, n)."""
    return rows.groupBy("cls", _bin(F.col("cx"), bins).alias("bx"), _bin(F.col("cy"), bins).alias("by")).agg(F.count(F.lit(1)).alias("n"))


def aspect(rows: DataFrame) -> DataFrame:
    """(cls, bin, n): width over height in 39 logarithmic bins from 0.2 to 20; others don't count."""
    lo, hi, bins = ASPECT
    v = F.col("nw") / F.col("nh")
    at = F.least(F.floor(F.log(v / lo) / F.lit(math.log(hi / lo)) * bins), F.lit(bins - 1)).cast("int")
    return rows.filter("nh > 0").filter((v >= lo) & (v <= hi)).groupBy("cls", at.alias("bin")).agg(F.count(F.lit(1)).alias("n"))


def box_area(rows: DataFrame, bins: int = 40) -> DataFrame:
    return rows.groupBy("cls", _bin(F.col("nw") * F.col("nh"), bins).alias("bin")).agg(F.count(F.lit(1)).alias("n"))


def page_aspect(pages: DataFrame, bins: int = 40) -> DataFrame:
    """(bin, n): width over height between the data's least and greatest; a single value has half a unit on each side."""
    v = pages.filter("height > 0").select((F.col("width") / F.col("height")).alias("v"))
    range_ = v.agg(F.min("v").alias("lo"), F.max("v").alias("hi"))  # one row
    flat = F.col("lo") == F.col("hi")
    lo, hi = F.when(flat, F.col("lo") - 0.5).otherwise(F.col("lo")), F.when(flat, F.col("hi") + 0.5).otherwise(F.col("hi"))
    return v.crossJoin(F.broadcast(range_)).select(_bin((F.col("v") - lo) / (hi - lo), bins).alias("bin")).groupBy("bin").agg(F.count(F.lit(1)).alias("n"))


def labels_per_page(pages: DataFrame, most: int = 50) -> DataFrame:
    """(labels, n): unit bins up to c = min(most, greatest); c + 1 falls in the last bin, more doesn't count."""
    c = F.least(F.lit(most), F.col("greatest"))
    top = pages.agg(F.max("n_rows").alias("greatest"))  # one row
    return pages.select("n_rows").crossJoin(F.broadcast(top)).filter(F.col("n_rows") <= c + 1).groupBy(F.least(F.col("n_rows"), c).cast("int").alias("labels")).agg(F.count(F.lit(1)).alias("n"))


def boxes_per_page(ann: DataFrame, images: DataFrame) -> DataFrame:
    """(paper_id, boxes, n): pages by their number of boxes, with 0 for pages without any."""
    counts = ann.groupBy("paper_id", "page").agg(F.count(F.lit(1)).alias("boxes"))
    empty = images.select("paper_id", "page").join(counts, ["paper_id", "page"], "left_anti").withColumn("boxes", F.lit(0).cast("bigint"))
    return counts.unionByName(empty).groupBy("paper_id", "boxes").agg(F.count(F.lit(1)).alias("n"))


def class_by_split(pages: DataFrame) -> DataFrame:
    """(split, cls, n) over the labels of page candidates."""
    return pages.select("split", F.explode("rows").alias("r")).groupBy("split", F.col("r.cls").alias("cls")).agg(F.count(F.lit(1)).alias("n"))


def split_totals(pages: DataFrame) -> DataFrame:
    return pages.groupBy("split").agg(F.count(F.lit(1)).alias("pages"), F.count_if(F.col("n_rows") > 0).alias("positive"), F.count_if(F.col("n_rows") == 0).alias("negative"))


def archive_by_class(pages: DataFrame, classes: int) -> DataFrame:
    """One row an archive: papers, pages and a column c<i> for each class."""
    wide = pages.select("archive", F.explode("rows").alias("r")).groupBy("archive").pivot("r.cls", list(range(classes))).agg(F.count(F.lit(1)))
    base = pages.groupBy("archive").agg(F.count_distinct("paper_id").alias("papers"), F.count(F.lit(1)).alias("pages"))
    return base.join(wide, "archive", "left").select("archive", "papers", "pages", *[F.coalesce(F.col(f"`{i}`"), F.lit(0)).alias(f"c{i}") for i in range(classes)])


def class_weights(counts: DataFrame, classes: DataFrame) -> DataFrame:
    """(kind, n, weight): the largest count over the own, clipped to 1..30; 30 without any. counts: (cls, n)."""
    total = counts.groupBy("cls").agg(F.sum("n").alias("n"))
    all_ = classes.join(total, "cls", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    top = all_.agg(F.greatest(F.max("n"), F.lit(1)).alias("top"))  # one row
    ratio = F.try_divide(F.col("top").cast("double"), F.col("n").cast("double"))
    weight = F.when(F.col("n") <= 0, 30.0).otherwise(F.bround(F.greatest(F.lit(1.0), F.least(F.lit(30.0), ratio)), 2))
    return all_.crossJoin(F.broadcast(top)).select("kind", "n", weight.alias("weight"))
