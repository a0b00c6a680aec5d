"""Corpus rollups, top lists, health and the balance scheduler. Input: papers (see schemas.PAPER)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from galley import schemas as S



def ok(papers: DataFrame) -> DataFrame:
    return papers.filter(F.col("status") == "ok")


def totals(papers: DataFrame) -> DataFrame:
    """One row: papers in any status, ok, failed, and sums over ok papers."""
    good = F.col("status") == "ok"
    add = lambda c: F.coalesce(F.sum(F.when(good, F.col(c))), F.lit(0)).alias(c)
    return papers.agg(
        F.count(F.lit(1)).alias("papers_total"), F.count_if(good).alias("papers_ok"), F.count_if(F.col("status") == "failed").alias("papers_failed"),
        add("pages_total"), add("pages_with_labels"), add("labels_total"),
    )


def histograms(papers: DataFrame) -> DataFrame:
    """(dimension, key, n) of archive, year (not empty) and primary category (not null) over ok papers, in one pass."""
    keys = F.array(
        *[F.struct(F.lit(d).alias("dimension"), F.col(c).alias("key")) for d, c in (("archive", "archive"), ("year", "year"), ("primary_category", "primary_category"))]
    )
    return ok(papers).select(F.explode(keys).alias("k")).select("k.*").filter("key is not null and (dimension = 'archive' or key <> '')").groupBy("dimension", "key").agg(F.count(F.lit(1)).alias("n"))


def histogram(papers: DataFrame, dimension: str) -> DataFrame:
    """(key, n) of one dimension."""
    return histograms(papers.select("status", *[F.col(c) if c == dimension else F.lit(None).cast("string").alias(c) for c in ("archive", "year", "primary_category")])).filter(F.col("dimension") == dimension).select("key", "n")


def merged_map(papers: DataFrame, column: str = "labels_by_kind") -> DataFrame:
    """(key, n): maps of ok papers added up."""
    return ok(papers).select(F.explode(column).alias("key", "v")).groupBy("key").agg(F.sum("v").alias("n"))


def failures(papers: DataFrame, column: str = "reason", blank: str = "?") -> DataFrame:
    """(key, n) of failed papers; null and empty keys count as ``blank``."""
    key = F.coalesce(F.nullif(F.col(column), F.lit("")), F.lit(blank))
    return papers.filter(F.col("status") == "failed").groupBy(key.alias("key")).agg(F.count(F.lit(1)).alias("n"))


def top(hist: DataFrame, k: int, ascending: bool = False) -> DataFrame:
    """The k largest (or least) keys; ties by key."""
    return hist.orderBy(F.asc("n") if ascending else F.desc("n"), "key").limit(k)


def archive_coverage(papers: DataFrame, archives: DataFrame) -> DataFrame:
    """(archive, ord, n): ok papers of each archive, 0 for untouched ones."""
    n = ok(papers).groupBy("archive").agg(F.count(F.lit(1)).alias("n"))
    return archives.join(n, "archive", "left").select("archive", "ord", F.coalesce("n", F.lit(0)).alias("n"))


def untouched(papers: DataFrame, archives: DataFrame) -> DataFrame:
    return archives.select("archive").join(ok(papers).select("archive"), "archive", "left_anti")


def covered(papers: DataFrame, archives: DataFrame) -> DataFrame:
    return archives.select("archive").join(ok(papers).select("archive"), "archive", "left_semi")


def starving_kinds(kind_counts: DataFrame, least_ratio: float = 4.0) -> DataFrame:
    """(kind, n, ratio) of algorithm and table where figures are over four times as many, scarcest
    first. kind_counts: (key, n). None without figures."""
    one = kind_counts.agg(*[F.coalesce(F.sum(F.when(F.col("key") == k, F.col("n"))), F.lit(0)).alias(k) for k in ("figure", "algorithm", "table")])
    long = one.selectExpr("figure", "stack(2, 'algorithm', algorithm, 'table', table) AS (kind, n)")
    return long.withColumn("ratio", F.col("figure") / F.greatest(F.lit(1), F.col("n"))).filter((F.col("figure") > 0) & (F.col("ratio") > least_ratio)).select("kind", "n", "ratio").orderBy(F.desc("ratio"), "kind")


def rate(part: Column, whole: Column) -> Column:
    """Per cent, 0 for nothing."""
    return F.coalesce(F.try_divide(part * F.lit(100.0), whole), F.lit(0.0))


def health(papers: DataFrame, archives: DataFrame, subsets: DataFrame | None = None) -> DataFrame:
    """One row: fail_rate and its level, archive coverage, the largest and least archive and their
    spread, the share of negative pages, and (given subsets: subset, papers_pass) whether passing papers grow from 8 to 4."""
    t = totals(papers)
    fail = rate(F.col("papers_failed"), F.col("papers_ok") + F.col("papers_failed"))
    a = archive_coverage(papers, archives).filter("n > 0").agg(
        F.count(F.lit(1)).alias("covered"), F.max_by("archive", F.struct("n", -F.col("ord"))).alias("top_archive"), F.max("n").alias("top_n"),
        F.min_by("archive", F.struct("n", "ord")).alias("bottom_archive"), F.min("n").alias("bottom_n"),
    )
    out = t.crossJoin(a).select(  # one row each
        "papers_total", "papers_ok", "papers_failed", F.round(fail, 6).alias("fail_rate"),
        F.when(fail <= 30, "good").when(fail <= 40, "warn").otherwise("bad").alias("fail_level"),
        F.round(rate(F.greatest(F.lit(0), F.col("pages_total") - F.col("pages_with_labels")), F.col("pages_total")), 6).alias("negative_share"),
        "covered", "top_archive", "bottom_archive", F.round(F.col("top_n") / F.greatest(F.lit(1), F.col("bottom_n")), 6).alias("spread"),
    )
    if subsets is None:
        return out
    p = subsets.agg(*[F.max(F.when(F.col("subset") == s, F.col("papers_pass"))).alias(f"p{s}") for s in S.SUBSETS])
    return out.crossJoin(p.select(((F.col("p8") <= F.col("p6")) & (F.col("p6") <= F.col("p4"))).alias("monotone")))


def recommendation(starving: DataFrame, control: dict, untouched_archives: DataFrame) -> DataFrame:
    """One row (rule, kind, archives): label balance first, then the forced archive, then untouched ones, else none."""
    spark = starving.sparkSession
    rich = spark.createDataFrame([(k, list(v)) for k, v in S.LABEL_RICH.items()], "kind string, rich array<string>")
    first = starving.orderBy(F.desc("ratio"), "kind").limit(1).join(F.broadcast(rich), "kind", "left").select("kind", "rich")
    idle = untouched_archives.agg(F.sort_array(F.collect_list("archive")).alias("idle"))
    force = control.get("force_next_archive")
    one = idle.join(first, F.lit(True), "left")  # one row each
    rule = F.when(F.col("kind").isNotNull(), "label_balance").when(F.lit(force is not None), "forced").when(F.size("idle") > 0, "untouched").otherwise("none")
    return one.select(rule.alias("rule"), "kind", F.when(rule == "label_balance", F.col("rich")).when(rule == "forced", F.array(F.lit(force))).when(rule == "untouched", F.col("idle")).otherwise(F.array().cast("array<string>")).alias("archives"))


# scheduler --------------------------------------------------------------------------------------


def bucket_counts(papers: DataFrame, buckets: DataFrame) -> DataFrame:
    """(archive, lo, hi, ord, n): ok papers by year bucket; years that aren't numbers don't count."""
    year = F.left(F.col("year"), F.lit(4)).try_cast("int")
    y = ok(papers).select("archive", year.alias("y")).filter("y is not null").groupBy("archive", "y").agg(F.count(F.lit(1)).alias("n"))
    return y.join(F.broadcast(buckets), F.col("y").between(F.col("lo"), F.col("hi"))).groupBy("archive", "lo", "hi", "ord").agg(F.sum("n").alias("n"))


def next_archive(papers: DataFrame, archives: DataFrame, quota: int | None = None, avoid: list[str] | None = None, force: str | None = None, seed: int = 0) -> DataFrame:
    """At most one row (archive, n): a forced archive that isn't avoided, whatever its quota; else the
    least covered below the quota, ties by a seeded hash."""
    c = archive_coverage(papers, archives).filter(~F.col("archive").isin(*(avoid or [])))
    forced = F.lit(False) if force is None else F.col("archive") == force
    open_ = c.filter(forced | (F.lit(True) if quota is None else F.col("n") < quota))
    return open_.orderBy(F.desc(forced), "n", F.sha2(F.concat(F.lit(f"{seed}|"), "archive"), 256)).limit(1).select("archive", "n")


def next_bucket(papers: DataFrame, archive: str, buckets: DataFrame, seed: int = 0) -> DataFrame:
    """One row (lo, hi, n): the least covered year bucket of the archive, ties by a seeded hash."""
    have = bucket_counts(papers.filter(F.col("archive") == archive), buckets)
    all_ = buckets.join(have.select("ord", "n"), "ord", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    return all_.orderBy("n", F.sha2(F.concat_ws("|", F.lit(str(seed)), F.lit(archive), F.col("lo").cast("string")), 256)).limit(1).select("lo", "hi", "n")


def pick(papers: DataFrame, spark: SparkSession, control: dict | None = None, quota: int | None = None, archives: tuple[str, ...] = S.ARCHIVES, seed: int = 0) -> tuple[str, tuple[int, int]] | None:
    """The next (archive, (lo, hi)) to query, or None if all are at their quota."""
    control = control or {}
    found = next_archive(papers, S.archives_dim(spark, archives), quota, list(control.get("skip_archive_query") or []), control.get("force_next_archive"), seed).first()
    if found is None:
        return None
    b = next_bucket(papers, found.archive, S.year_buckets_dim(spark), seed).first()
    return found.archive, (b.lo, b.hi)


def screened(candidates: DataFrame, papers: DataFrame, skip_categories: list[str]) -> DataFrame:
    """Candidates not seen before, with status and reason: those of a skipped category fail at once."""
    category = F.coalesce("primary_category", F.lit(""))
    skip = category.isin(*skip_categories) if skip_categories else F.lit(False)
    fresh = candidates.join(papers.select("arxiv_id"), "arxiv_id", "left_anti")
    return fresh.withColumns({"status": F.when(skip, F.lit("failed")).otherwise(F.lit("fetched")), "reason": F.when(skip, F.concat(F.lit("skip_primary_cat:"), category)).otherwise(F.lit(""))})


def target_reached(papers: DataFrame, max_images: int | None = None, max_papers: int | None = None) -> bool:
    t = totals(papers).first()
    return (max_images is not None and t.pages_with_labels >= max_images) or (max_papers is not None and t.papers_ok >= max_papers)


def run_summary(outcomes: DataFrame) -> DataFrame:
    """One row: papers, ok papers, and the labels of ok papers. outcomes: paper_id, ok, labels."""
    return outcomes.agg(F.count(F.lit(1)).alias("papers"), F.count_if("ok").alias("papers_ok"), F.coalesce(F.sum(F.when(F.col("ok"), F.col("labels"))), F.lit(0)).alias("labels"))
