"""The build of papers, from their source files to annotation documents: sources -> one text -> marks -> compile run -> positions -> boxes.

All steps are relations over many papers; the compiler is a connector (sources.connect). A paper that fails at a step has its reason in the
outcome, and the others go on."""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from galley.operators import resolve, rollup, tex
from galley.sources import connect, sinks, typeset


class Built(NamedTuple):
    outcomes: DataFrame  # paper_id, ok, reason, engine, labels
    annotations: DataFrame  # as resolve.coco_annotations
    categories: DataFrame
    images: DataFrame
    labels: DataFrame  # boxes in points
    documents: DataFrame  # paper_id, document


def build(files: DataFrame, run: Callable[[str, str, str], dict], dpi: int = 200, keep: Callable[[DataFrame, str], DataFrame] | None = None) -> Built:
    """Papers of (paper_id, path, text), compiled by ``run`` (see connect.compiled). ``keep(df, name)`` writes what several steps
    read (the marked texts and the compile run), so that no paper is compiled twice; without it Spark keeps them in memory and on disk."""
    keep = keep or (lambda df, _: df.persist())
    everyone = files.select(F.col("paper_id").cast("string").alias("paper_id")).distinct()
    flat = tex.flattened(files)
    marked = keep(tex.instrument(flat.select("paper_id", "text")), "marked")
    compiled = keep(connect.compiled(marked, run), "compiled")
    good = compiled.filter("ok")
    aux, log = (good.select("paper_id", F.col(c).alias("text")) for c in ("aux", "log"))
    out = typeset.compile_outputs(aux, log)
    pages = connect.page_sizes(compiled)
    manifest = tex.manifest(marked)
    boxes = resolve.resolve_labels(manifest, out["anchors"], out["boxes"], out["marks"], out["page_info"], pages)
    labels = keep(resolve.cleaned(resolve.union_with_bodies(boxes), pages), "labels")
    annotations, categories, images = resolve.coco_annotations(labels, dpi), resolve.coco_categories(labels), connect.rasters(pages, dpi)
    found = labels.groupBy("paper_id").agg(F.count(F.lit(1)).alias("labels"))
    outcomes = (
        everyone.join(flat.select("paper_id", F.lit(True).alias("main")), "paper_id", "left").join(compiled.select("paper_id", "ok", "reason", "engine"), "paper_id", "left")
        .join(out["page_info"].select("paper_id", F.lit(True).alias("geometry")), "paper_id", "left").join(found, "paper_id", "left")
    )
    reason = (
        F.when(F.col("main").isNull(), "no main tex found").when(~F.col("ok"), F.concat(F.lit("compile failed ("), "reason", F.lit(")")))
        .when(F.col("geometry").isNull(), "no PAGEINFO in log").otherwise("")
    )
    outcomes = outcomes.select("paper_id", (reason == "").alias("ok"), reason.alias("reason"), "engine", F.coalesce("labels", F.lit(0)).alias("labels"))
    return Built(outcomes, annotations, categories, images, labels, sinks.coco_documents(annotations, categories, images, dpi))


def summary(built: Built) -> DataFrame:
    """One row: papers, ok papers, labels of ok papers."""
    return rollup.run_summary(built.outcomes.select("paper_id", "ok", "labels"))
