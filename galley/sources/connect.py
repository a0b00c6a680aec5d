"""Connectors that run per row on the executors: downloads, unpacking, compilers, rasterisers and image writers. What reaches outside is a
function that the caller gives; a row whose function fails carries the problem in a column, and no other row notices.

``each_row`` is the one place where rows meet Python: all connectors are a function of a row and a schema."""

from __future__ import annotations

import io
import posixpath
import tarfile
import zlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from galley import schemas as S
from galley.functions.geometry import resized
from galley.functions.text import engines, stem

#: Rows of Arrow batches that a connector holds at once: their contents may be large.
AT_ONCE = 16
#: Bytes that one archive may unpack to.
MOST_BYTES = 1 << 30
# Files of a build, which a copy of a source tree leaves out.
BUILD_FILES = (".aux", ".log", ".out", ".synctex.gz", ".fls", ".fdb_latexmk", ".xdv")


def each_row(rows: DataFrame, schema: str, make: Callable[[dict], Iterator[dict]]) -> DataFrame:
    """The rows that ``make`` gives for each row (as a dict)."""
    target = to_arrow_schema(S.struct(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, AT_ONCE):
                out = [made for row in b.slice(at, AT_ONCE).to_pylist() for made in make(row)]
                yield pa.RecordBatch.from_pylist(out, schema=target)

    return rows.mapInArrow(run, S.struct(schema))


def _guarded(call: Callable[[], object]) -> tuple[object, str]:
    """What a call gives, and what went wrong ('' if nothing)."""
    try:
        return call(), ""
    except Exception as e:  # a connector may raise anything
        return None, f"{type(e).__name__}: {e}"[:500]


# sources --------------------------------------------------------------------------------------------


def seeds(spark: SparkSession, path: str, only: list[str] | None = None) -> DataFrame:
    """(arxiv_id, note) of a text file with an id a line, and a note behind white space; # begins a comment. only: of those, these."""
    line = F.trim(F.regexp_replace("value", "#.*$", ""))
    out = spark.read.text(path).select(F.split(line, r"\s+", 2).alias("p")).filter(F.col("p")[0] != "").select(F.col("p")[0].alias("arxiv_id"), F.coalesce(F.get("p", F.lit(1)), F.lit("")).alias("note")).distinct()
    return out.filter(F.col("arxiv_id").isin(only)) if only else out


def downloads(papers: DataFrame, fetch: Callable[[str], bytes], attempts: int = 5, sleep: Callable[[float], None] | None = None) -> DataFrame:
    """(paper_id, content, problem) of (paper_id, source_url)."""
    from galley.sources.catalog import call

    more = {} if sleep is None else {"sleep": sleep}

    def make(row: dict) -> Iterator[dict]:
        content, problem = _guarded(lambda: call(fetch, row["source_url"], attempts, **more))
        yield {"paper_id": row["paper_id"], "content": content, "problem": problem}

    return each_row(papers.select("paper_id", "source_url"), "paper_id string, content binary, problem string", make)


def _members(content: bytes, most: int) -> Iterator[tuple[str, bytes]]:
    """(path, bytes) of the files of an archive: tar, tar in gzip, one file in gzip, or a bare TeX text."""
    if content[:2] == b"\x1f\x8b":
        plain = zlib.decompressobj(wbits=31)
        body = plain.decompress(content, most + 1)
        if len(body) > most:
            raise ValueError("unpacks to too much")
        content = body
    try:
        archive = tarfile.open(fileobj=io.BytesIO(content), mode="r:")
    except tarfile.TarError:
        if not content.strip() or b"\0" in content[:4096]:
            raise ValueError("neither an archive nor a text") from None
        yield "main.tex", content
        return
    total = 0
    with archive:
        for m in archive:
            path = posixpath.normpath(m.name)
            if m.issym() or m.islnk():
                raise ValueError(f"a link: {m.name}")
            if posixpath.isabs(path) or path.split("/")[0] == "..":
                raise ValueError(f"leaves the folder: {m.name}")
            if m.isfile():
                total += m.size
                if total > most:
                    raise ValueError("unpacks to too much")
                yield path, archive.extractfile(m).read()


def unpacked(archives: DataFrame, most: int = MOST_BYTES) -> DataFrame:
    """(paper_id, path, content, problem) of (paper_id, content): a row for each file, or one with the problem alone where the
    archive can't be read, has a link, or names a file outside its folder: such an archive gives no file."""

    def make(row: dict) -> Iterator[dict]:
        found, problem = _guarded(lambda: list(_members(row["content"] or b"", most)))
        if problem:
            yield {"paper_id": row["paper_id"], "path": None, "content": None, "problem": problem}
        for path, content in found or ():
            yield {"paper_id": row["paper_id"], "path": path, "content": content, "problem": ""}

    return each_row(archives.select("paper_id", "content"), "paper_id string, path string, content binary, problem string", make)


def texts(files: DataFrame) -> DataFrame:
    """(paper_id, path, text) of the TeX files among (paper_id, path, content), without what a build left. Bytes that aren't UTF-8 are replaced."""
    built = F.lit(False)
    for end in BUILD_FILES:
        built = built | F.col("path").endswith(end)
    return files.filter(F.col("path").isNotNull() & ~built & F.lower("path").rlike(r"\.(tex|sty|cls|bbl)$")).select("paper_id", "path", F.make_valid_utf8(F.col("content").cast("string")).alias("text"))


# compiling ------------------------------------------------------------------------------------------

COMPILED = "paper_id string, ok boolean, engine string, reason string, aux string, log string, pages array<struct<page:int,width_pt:double,height_pt:double>>"


def compiled(papers: DataFrame, run: Callable[[str, str, str], dict], hint: str | None = None) -> DataFrame:
    """COMPILED of (paper_id, text): run(engine, paper_id, text) gives aux, log and pages ((width, height) in points), or raises. Engines are
    tried in the order that the text asks for; the reason of a paper that none compiles has what each said."""

    def make(row: dict) -> Iterator[dict]:
        said = []
        for engine in row["engines"]:
            got, problem = _guarded(lambda: run(engine, row["paper_id"], row["text"]))  # noqa: B023
            if not problem and not got.get("pages"):
                problem = "no pages"
            if not problem:
                pages = [{"page": i, "width_pt": float(w), "height_pt": float(h)} for i, (w, h) in enumerate(got["pages"], 1)]
                yield {"paper_id": row["paper_id"], "ok": True, "engine": engine, "reason": "", "aux": got["aux"], "log": got["log"], "pages": pages}
                return
            said.append(f"{engine}: {problem}")
        yield {"paper_id": row["paper_id"], "ok": False, "engine": None, "reason": "; ".join(said), "aux": None, "log": None, "pages": []}

    order = engines(F.col("text"), F.lit(hint) if hint else None)
    return each_row(papers.select("paper_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("engines", order), COMPILED, make)


def page_sizes(compiled_papers: DataFrame) -> DataFrame:
    """(paper_id, page, width_pt, height_pt)."""
    return compiled_papers.filter("ok").select("paper_id", F.explode("pages").alias("p")).select("paper_id", "p.*")


# images ---------------------------------------------------------------------------------------------


def rasters(pages: DataFrame, dpi: int = 200) -> DataFrame:
    """(paper_id, page, file_name, width, height): the pixel size of each page at a resolution."""
    px = lambda v: F.rint(F.col(v) * F.lit(dpi / 72.0)).cast("int")
    return pages.select("paper_id", "page", F.format_string("page_%03d.png", "page").alias("file_name"), px("width_pt").alias("width"), px("height_pt").alias("height"))


def emitted(candidates: DataFrame, render: Callable[[str, int, int, int], bytes], short_side: int = 0) -> DataFrame:
    """(split, stem, width, height, image, problem) of candidates (split, paper_id, page, width, height): the image in the size that a short side
    gives. Where its short side doesn't shrink the renderer is asked for the page as it is."""
    w, h = resized(F.col("width"), F.col("height"), short_side)
    asked = candidates.select("split", "paper_id", "page", stem(F.col("paper_id").cast("string"), F.col("page").cast("int")).alias("stem"), w.alias("width"), h.alias("height"))

    def make(row: dict) -> Iterator[dict]:
        image, problem = _guarded(lambda: render(row["paper_id"], row["page"], row["width"], row["height"]))
        yield {"split": row["split"], "stem": row["stem"], "width": row["width"], "height": row["height"], "image": image, "problem": problem}

    return each_row(asked.withColumn("paper_id", F.col("paper_id").cast("string")), "split string, stem string, width int, height int, image binary, problem string", make)
