"""Relations parsed from the texts that a TeX run leaves: anchors from .aux, page geometry, box and
mark sizes from .log. Input: (paper_id, text). Of repeated names the last holds; of page geometry the first."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from galley.functions.geometry import dimension_sp

# Fixed formats of the lines.
ANCHOR = r"\\zref@newlabel\{([^{}]+)\}\{([^{}]*(?:\{[^{}]*\}[^{}]*)*)\}"
PAGEINFO = r"ARXIVLAYOUT-PAGEINFO\s+(.+)"
BOX = r"ARXIVLAYOUT-BOX\s+id=(\S+)\s+width=(-?[\d.]+pt)\s+height=(-?[\d.]+pt)\s+depth=(-?[\d.]+pt)(?:\s+hsize=(-?[\d.]+pt))?"
MARK = r"ARXIVLAYOUT-MARK\s+id=(\S+)\s+hsize=(-?[\d.]+pt)\s+linewidth=(-?[\d.]+pt)\s+columnwidth=(-?[\d.]+pt)"
PAGE_FIELDS = ("paperwidth", "paperheight", "textwidth", "textheight", "oddsidemargin", "topmargin", "headheight", "headsep", "columnwidth", "columnsep")


def read_texts(spark, path: str, depth: int = -2) -> DataFrame:
    """(paper_id, text) of whole files; the paper is the path's part at ``depth`` from the end."""
    text = spark.read.option("wholetext", True).text(path)
    return text.select(F.element_at(F.split(F.col("_metadata.file_path"), "/"), depth).alias("paper_id"), F.col("value").alias("text"))


def _matches(texts: DataFrame, pattern: str) -> DataFrame:
    """(paper_id, pos, hit): all matches in order."""
    return texts.select("paper_id", F.posexplode(F.regexp_extract_all("text", F.lit(pattern), F.lit(0))).alias("pos", "hit"))


def _last(rows: DataFrame, name: str, fields: list[str]) -> DataFrame:
    kept = rows.groupBy("paper_id", name).agg(F.max_by(F.struct(*fields), "pos").alias("v"))
    return kept.select("paper_id", name, "v.*")


def anchors(texts: DataFrame) -> DataFrame:
    """paper_id, name, posx_sp, posy_sp, abspage (0 if absent). Labels without both positions don't count."""
    part: dict[str, Column] = {k: F.regexp_extract("hit", rf"\\{k}\{{(-?\d+)\}}", 1).try_cast("bigint") for k in ("posx", "posy", "abspage")}
    rows = _matches(texts, ANCHOR).select(
        "paper_id", "pos", F.regexp_extract("hit", ANCHOR, 1).alias("name"), part["posx"].alias("posx_sp"), part["posy"].alias("posy_sp"), F.coalesce(part["abspage"], F.lit(0)).alias("abspage")
    )
    return _last(rows.filter("posx_sp is not null and posy_sp is not null"), "name", ["posx_sp", "posy_sp", "abspage"])


def page_info(texts: DataFrame) -> DataFrame:
    """One row a paper with a geometry line: *_sp of all fields, 0 where absent; the last of a repeated key."""
    rest = F.regexp_extract("text", PAGEINFO, 1)
    pairs = F.transform(F.filter(F.split(rest, r"\s+"), lambda t: F.contains(t, F.lit("="))), lambda t: F.struct(F.substring_index(t, "=", 1).alias("k"), F.substring(t, F.instr(t, "=") + 1, F.length(t)).alias("v")))
    found = texts.withColumn("rest", rest).filter("rest <> ''").withColumn("pairs", pairs)
    value = lambda n: F.element_at(F.concat(F.array(F.lit("")), F.transform(F.filter("pairs", lambda p: p.k == n), lambda p: p.v)), -1)
    return found.select("paper_id", *[dimension_sp(value(n)).alias(f"{n}_sp") for n in PAGE_FIELDS])


def boxes(texts: DataFrame) -> DataFrame:
    """paper_id, box_id, width_sp, height_sp, depth_sp, hsize_sp (0 if absent)."""
    names = ["width_sp", "height_sp", "depth_sp", "hsize_sp"]
    rows = _matches(texts, BOX).select("paper_id", "pos", F.regexp_extract("hit", BOX, 1).alias("box_id"), *[dimension_sp(F.regexp_extract("hit", BOX, i)).alias(n) for i, n in enumerate(names, 2)])
    return _last(rows, "box_id", names)


def marks(texts: DataFrame) -> DataFrame:
    """paper_id, mark_id, hsize_sp, linewidth_sp, columnwidth_sp."""
    names = ["hsize_sp", "linewidth_sp", "columnwidth_sp"]
    rows = _matches(texts, MARK).select("paper_id", "pos", F.regexp_extract("hit", MARK, 1).alias("mark_id"), *[dimension_sp(F.regexp_extract("hit", MARK, i)).alias(n) for i, n in enumerate(names, 2)])
    return _last(rows, "mark_id", names)


def compile_outputs(aux: DataFrame, log: DataFrame) -> dict[str, DataFrame]:
    return {"anchors": anchors(aux), "page_info": page_info(log), "boxes": boxes(log), "marks": marks(log)}
