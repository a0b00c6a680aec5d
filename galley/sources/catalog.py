"""The paper catalog: API entries to rows, paging, and dedupe that remembers every archive."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from galley import schemas as S
from galley.functions.text import id_of_url, year_of

ENTRY = (
    "id string, title string, summary string, published string, updated string, primary string, tags array<string>, authors array<string>, "
    "links array<struct<href:string,type:string>>, comment string, journal_ref string, doi string, queried_archive string, arrival bigint"
)


def catalog_rows(entries: DataFrame) -> DataFrame:
    """Rows of the catalog from API entries (see ENTRY). The category of its own wins over the first tag."""
    blank = lambda c: F.coalesce(c, F.lit(""))
    aid = id_of_url(F.col("id"))
    pdf = F.get(F.filter("links", lambda x: x.type == "application/pdf"), F.lit(0)).href
    tags = F.filter(F.coalesce("tags", F.array().cast("array<string>")), lambda t: t != "")
    return entries.select(
        aid.alias("arxiv_id"), F.col("id").alias("abs_url"), F.coalesce(pdf, F.concat(F.lit("https://arxiv.org/pdf/"), aid)).alias("pdf_url"), F.concat(F.lit("https://arxiv.org/e-print/"), aid).alias("source_url"),
        F.trim(blank(F.col("title"))).alias("title"), F.trim(blank(F.col("summary"))).alias("summary"), F.coalesce("authors", F.array().cast("array<string>")).alias("authors"),
        F.coalesce("primary", F.get(tags, F.lit(0))).alias("primary_category"), tags.alias("categories"), blank(F.col("published")).alias("published"), blank(F.col("updated")).alias("updated"),
        F.left(blank(F.col("published")), F.lit(4)).alias("year"), blank(F.col("comment")).alias("comment"), blank(F.col("journal_ref")).alias("journal_ref"), blank(F.col("doi")).alias("doi"), F.lit("ok").alias("status"),
        "queried_archive", "arrival",
    )


def dedupe(rows: DataFrame) -> DataFrame:
    """The first arrival of each arxiv_id, with also_in_archives: all archives that surfaced it, in order of arrival. A list is made once
    for an id, not for each of its rows."""
    first = F.min_by(F.struct(*rows.columns), F.struct("arrival", "queried_archive")).alias("first")
    seen = F.array_sort(F.collect_list(F.struct("arrival", "queried_archive"))).alias("seen")
    found = rows.groupBy("arxiv_id").agg(first, seen)
    return found.select("first.*", F.transform("seen", lambda x: x.queried_archive).alias("also_in_archives"))


def per_archive(rows: DataFrame, target: int) -> DataFrame:
    """The first ``target`` distinct papers of each queried archive, by arrival."""
    one = rows.withColumn("_n", F.row_number().over(Window.partitionBy("queried_archive", "arxiv_id").orderBy("arrival"))).filter("_n = 1")
    return one.withColumn("_k", F.row_number().over(Window.partitionBy("queried_archive").orderBy("arrival"))).filter(F.col("_k") <= target).drop("_n", "_k")


def land(rows: DataFrame, path: str) -> None:
    """The catalog as Parquet by archive, with the year as a number (0 where it is none): a paper of several archives lies in each of their folders."""
    archives = F.array_distinct(F.transform("categories", lambda c: F.substring_index(c, ".", 1)))
    keyed = rows.withColumns({"archive": F.explode_outer(archives), "published_year": year_of(F.col("published"))})
    keyed.repartition("archive", "published_year").sortWithinPartitions("published_year").write.mode("overwrite").partitionBy("archive").parquet(path)


def candidates(catalog: DataFrame, archive: str, lo: int, hi: int, seen: DataFrame, most: int, offset: int = 0) -> DataFrame:
    """The query of the scheduler over a catalog: newest first, then papers not seen before. Entries whose year isn't
    a number pass. Of a catalog that ``land`` wrote, the scan reads the archive's folder alone, and skips row groups by year."""
    year = F.col("published_year") if "published_year" in catalog.columns else year_of(F.col("published"))
    ours = F.exists("categories", lambda c: (c == archive) | c.startswith(f"{archive}."))
    rows = catalog.filter(F.col("archive") == archive) if "archive" in catalog.columns else catalog
    page = rows.filter(((year >= lo) & (year <= hi)) | (year == 0)).filter(ours).orderBy(F.desc("published"), "arxiv_id").offset(offset).limit(most)
    fresh = page.join(seen.select("arxiv_id"), "arxiv_id", "left_anti")
    return fresh.select("arxiv_id", "title", "abs_url", "source_url", "primary_category", "categories", F.when(year != 0, year.cast("string")).otherwise("").alias("year"), "published")


def call(fetch: Callable[[str], bytes], url: str, attempts: int = 5, sleep: Callable[[float], None] = time.sleep) -> bytes:
    """fetch(url) with retries: 30, 60, 120 ... seconds after an error with code 429, else 2, 4, 6 ..."""
    last: Exception | None = None
    for k in range(attempts):
        try:
            return fetch(url)
        except Exception as e:  # any transport error
            last = e
            sleep(30.0 * 2**k if getattr(e, "code", None) == 429 else 2.0 * (k + 1))
    raise RuntimeError(f"{url}: {attempts} attempts failed") from last


def scan(spark: SparkSession, archives: list[str], page: Callable[[str, int, int], list[dict]], target: int, page_size: int = 100, attempts: int = 3, sleep: Callable[[float], None] = time.sleep) -> DataFrame:
    """API entries of all archives, one task each: ``page(archive, start, size)`` is the transport, asked ``attempts`` times. A short page ends an archive;
    an archive that fails gives what it has. Rows follow ENTRY."""
    names = [f.name for f in S.struct(ENTRY)]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for archive, order in zip(b.archive, b.ord, strict=True):
                got, seen, start = [], set(), 0
                while len(got) < target:
                    want = min(page_size, target - len(got))
                    found = None
                    for k in range(attempts):
                        try:
                            found = page(archive, start, want)
                            break
                        except Exception:  # any transport error
                            if k + 1 < attempts:
                                sleep(2.0 * (k + 1))
                    if found is None:
                        break
                    for e in found:
                        if e["id"] not in seen and len(got) < target:
                            seen.add(e["id"])
                            got.append({n: e.get(n) for n in names} | {"queried_archive": archive, "arrival": int(order) * 1_000_000 + len(got)})
                    start += page_size
                    if len(found) < want:
                        break
                if got:
                    yield pd.DataFrame(got, columns=names)

    dim = S.archives_dim(spark, tuple(archives)).repartition(max(1, len(archives)), "archive")
    return dim.mapInPandas(run, ENTRY)
