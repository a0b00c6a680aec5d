"""Names, formats, hashes and parses as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def without_version(arxiv_id: Column) -> Column:
    return F.regexp_replace(arxiv_id, r"v\d+$", "")


def slug(arxiv_id: Column, title: Column, archive: Column) -> Column:
    """Workspace name: id, archive and up to six title words. The archive loses its hyphens only where
    title words follow."""
    words = F.slice(F.split(F.regexp_replace(F.regexp_replace(F.lower(title), "[^a-zA-Z0-9]+", "_"), "^_+|_+$", ""), "_"), 1, 6)
    suffix = F.left(F.array_join(F.filter(words, lambda w: w != ""), "_"), F.lit(40))
    return F.left(F.when(suffix != "", F.concat_ws("_", arxiv_id, F.regexp_replace(archive, "-", ""), suffix)).otherwise(F.concat_ws("_", arxiv_id, archive)), F.lit(90))


def stem(paper_id: Column, page: Column) -> Column:
    return F.concat(paper_id, F.lit("__page_"), F.format_string("%03d", page))


def hash_split(s: Column, weights: tuple[int, int, int] = (8, 1, 1)) -> Column:
    """train, val or test: the first eight bytes of SHA-256, big-endian, modulo the sum of the weights."""
    total = sum(weights)
    if total <= 0 or min(weights) < 0:
        raise ValueError("weights must not be negative, and not all 0")
    bucket = F.conv(F.substring(F.sha2(s, 256), 1, 16), 16, 10).cast("decimal(20,0)") % F.lit(total).cast("decimal(20,0)")
    return F.when(bucket < weights[0], "train").when(bucket < weights[0] + weights[1], "val").otherwise("test")


def six(v: Column) -> Column:
    """Six decimals, as %.6f does it: format_number rounds the exact value, ties to even."""
    return F.format_number(v, 6)


def yolo_line(cls: Column, cx: Column, cy: Column, w: Column, h: Column) -> Column:
    return F.concat_ws(" ", cls.cast("string"), six(cx), six(cy), six(w), six(h))


def parse_yolo(line: Column) -> Column:
    """struct(cls, cx, cy, nw, nh) of a label line; nulls where a part doesn't parse."""
    parts = F.split(F.trim(line), r"\s+")
    number = lambda i: F.try_element_at(parts, F.lit(i))
    return F.struct(number(1).try_cast("int").alias("cls"), *[number(i).try_cast("double").alias(n) for i, n in ((2, "cx"), (3, "cy"), (4, "nw"), (5, "nh"))])


def id_of_url(url: Column) -> Column:
    return F.substring_index(url, "/abs/", -1)


def year_of(text: Column) -> Column:
    """The first four characters as a number, else 0."""
    return F.coalesce(F.left(text, F.lit(4)).try_cast("int"), F.lit(0))


def date_range(lo: Column, hi: Column) -> Column:
    return F.format_string("submittedDate:[%d01010000 TO %d12312359]", lo, hi)


def thousands(n: Column) -> Column:
    return F.format_number(n, 0)


def utc_now() -> Column:
    return F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss'Z'")


def base_kind(kind: Column) -> Column:
    return F.regexp_replace(kind, "_cap$", "")


def environments(text: Column, names: tuple[str, ...]) -> Column:
    """Which of the environments a TeX text begins."""
    return F.array_compact(F.array(*[F.when(text.rlike(rf"\\begin\{{{n}\*?\}}"), F.lit(n)) for n in names]))


def main_file_score(path: Column, text: Column, size: Column) -> Column:
    """Null for files that can't be the main file; otherwise size, bonus for usual names, less for
    depth and for words like template. path is relative to the source root."""
    low = F.lower(path)
    name = F.substring_index(low, "/", -1)
    bonus = F.when(name == "main.tex", 1000).when(name == "paper.tex", 900).when(name == "ms.tex", 800).when(name == "manuscript.tex", 780).otherwise(0)
    bad = sum((F.when(F.contains(low, F.lit(w)), 400).otherwise(0) for w in ("template", "sample", "supplement", "appendix")), F.lit(0))
    return F.when(F.contains(text, F.lit("\\documentclass")) & F.contains(text, F.lit("\\begin{document}")), size + bonus - 25 * F.size(F.split(path, "/")) - bad)


def engines(text: Column, hint: Column | None = None) -> Column:
    """Compilers in order of preference for a TeX text, the hint first where it is one of them."""
    low = F.lower(text)
    has = lambda *words: F.greatest(*[F.contains(low, F.lit(w)) for w in (*words, words[0])])
    names = lambda *x: F.array(*[F.lit(v) for v in x])
    order = (
        F.when(has("fontspec", "xecjk", "xetex", "\\setmainfont", "ctex"), names("xelatex", "lualatex", "pdflatex"))
        .when(has("luatex", "luacode"), names("lualatex", "xelatex", "pdflatex"))
        .otherwise(names("pdflatex", "xelatex", "lualatex"))
    )
    if hint is None:
        return order
    return F.when(F.array_contains(order, hint), F.concat(F.array(hint), F.filter(order, lambda e: e != hint))).otherwise(order)
