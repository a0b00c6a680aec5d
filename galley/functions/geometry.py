"""Coordinates and boxes as Column expressions. Guards keep every expression safe in ANSI mode."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Scaled points in a TeX point, and in a PDF point (72.27 TeX points to an inch, 72 PDF points).
SP_PER_TEX_PT = 65536
SP_PER_PT = SP_PER_TEX_PT * 72.27 / 72.0

c = F.col


def _lit(x) -> Column:
    return x if isinstance(x, Column) else F.lit(x)


def pt(sp: Column) -> Column:
    """PDF points of scaled points."""
    return sp / F.lit(SP_PER_PT)


def dimension_sp(raw: Column) -> Column:
    """Scaled points of texts like ``12.5pt`` or ``7sp``, 0 for others; ties round to even."""
    number = F.regexp_extract(raw, r"^\s*(-?[\d.]+)\s*(?:pt|sp)\s*$", 1)
    value = number.try_cast("double")
    factor = F.when(F.regexp_extract(raw, r"(pt|sp)\s*$", 1) == "pt", F.lit(float(SP_PER_TEX_PT))).otherwise(F.lit(1.0))
    return F.coalesce(F.rint(value * factor).cast("bigint"), F.lit(0).cast("bigint"))


def area(x0: Column, y0: Column, x1: Column, y1: Column) -> Column:
    return F.greatest(F.lit(0.0), x1 - x0) * F.greatest(F.lit(0.0), y1 - y0)


def clip(v: Column, hi, lo=0.0) -> Column:
    return F.greatest(_lit(lo), F.least(v, _lit(hi)))


def contained(bx: Column, by: Column, bw: Column, bh: Column, cx: Column, cy: Column, cw: Column, ch: Column, threshold: float) -> Column:
    """Whether at least threshold of the body box lies in the caption box (x, y, width, height)."""
    w = F.greatest(F.lit(0.0), F.least(bx + bw, cx + cw) - F.greatest(bx, cx))
    h = F.greatest(F.lit(0.0), F.least(by + bh, cy + ch) - F.greatest(by, cy))
    return (w * h) / F.greatest(F.lit(1e-9), bw * bh) >= F.lit(threshold)


def text_block(p: str = "") -> dict[str, Column]:
    """Derived page geometry in PDF points, from the scaled-point columns of page_info."""
    sp = lambda n: c(f"{p}{n}_sp")
    left = F.lit(72.0) + pt(sp("oddsidemargin"))
    top = F.lit(72.0) + pt(sp("topmargin") + sp("headheight") + sp("headsep"))
    textwidth = pt(sp("textwidth"))
    return {
        "text_left": left,
        "text_right": left + textwidth,
        "text_top": top,
        "text_bot": top + pt(sp("textheight")),
        "textwidth": textwidth,
        "columnwidth": F.when(sp("columnwidth") > 0, pt(sp("columnwidth"))).otherwise(textwidth),
        "columnsep": pt(sp("columnsep")),
        "paperwidth": pt(sp("paperwidth")),
        "paperheight": pt(sp("paperheight")),
        "columns_est": F.when((sp("columnwidth") > 0) & (sp("textwidth") > 0), sp("textwidth") / sp("columnwidth")).otherwise(F.lit(1.0)),
    }


def pixels(v: Column, dpi) -> Column:
    return v * (_lit(dpi) / F.lit(72.0))


def resized(w: Column, h: Column, short_side: int) -> tuple[Column, Column]:
    """Width and height with the short side capped; ties round to even; unlimited for 0."""
    small = F.least(w, h)
    scale = F.when((F.lit(short_side) > 0) & (small > short_side), F.lit(float(short_side)) / small).otherwise(F.lit(1.0))
    side = lambda v: F.greatest(F.lit(1), F.rint(v * scale).cast("int"))
    return side(w), side(h)


def image_size(short_side: int) -> int:
    """The training image size for a short side."""
    return max(640, min(1280, short_side + 256)) if short_side > 0 else 960
