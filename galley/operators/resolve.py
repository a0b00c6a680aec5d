"""From anchors to boxes: joins of the manifest with anchors, boxes, marks and page geometry.

Relations: manifest (paper_id, ord, label_id, kind, float_id, anchor_names, method, use_textblock_x),
anchors (paper_id, name, posx_sp, posy_sp, abspage), boxes (paper_id, box_id, width_sp, height_sp,
depth_sp, hsize_sp), marks (paper_id, mark_id, hsize_sp, ...), page_info (paper_id, *_sp; one row
a paper), pages (paper_id, page, width_pt, height_pt). Result: paper_id, ord, label_id, kind, page, x0, y0, x1, y1 in PDF points from the top left.

Every relation is dealt by paper once, before its rows are exploded; all joins, groups and windows then lie inside a paper and need no further exchange."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from galley.functions.dealing import by_paper
from galley.functions.geometry import area, clip, pixels, pt, text_block

OUT = ["paper_id", "ord", "label_id", "kind", "page", "x0", "y0", "x1", "y1"]
_CAP_ENDS = ("alx@cap@top@", "alx@cap@bot@")


def placed(manifest: DataFrame, anchors: DataFrame, hooks: bool = False) -> DataFrame:
    """Labels with their anchors that exist: ``found``, an array of (i, name, x, y, page), i the place in anchor_names; and ``ends``,
    with hooks those of a caption's own hooks. Every name is looked up in one join."""
    n = F.size("anchor_names")
    names = F.transform("anchor_names", lambda x, i: F.struct(i.alias("i"), x.alias("name")))
    if hooks:
        own = F.array(*[F.struct(F.lit(-1).alias("i"), F.concat(F.lit(p), "label_id").alias("name")) for p in _CAP_ENDS])
        names = F.when(F.col("kind").endswith("_cap"), F.concat(names, own)).otherwise(names)
    wanted = by_paper(manifest.filter(n > 0)).withColumn("n_names", n).select("*", F.explode(names).alias("want"))
    at = by_paper(anchors).select("paper_id", F.col("name").alias("at_name"), F.col("posx_sp").alias("x"), F.col("posy_sp").alias("y"), F.col("abspage").alias("page"))
    j = wanted.join(at, (wanted.paper_id == at.paper_id) & (F.col("want.name") == F.col("at_name"))).drop(at.paper_id)
    spot = F.struct(F.col("want.i").alias("i"), F.col("at_name").alias("name"), "x", "y", "page")
    label = ["label_id", "kind", "float_id", "method", "use_textblock_x", "n_names"]
    grouped = j.groupBy("paper_id", "ord").agg(*[F.first(c).alias(c) for c in label], F.array_sort(F.collect_list(spot)).alias("all"))
    return grouped.select("paper_id", "ord", *label, F.filter("all", lambda s: s.i >= 0).alias("found"), F.filter("all", lambda s: s.i < 0).alias("ends"))


def _pair():
    """The first (top, bot) pair of anchors of a span label that both exist; null for others."""
    of = lambda half: F.filter("found", lambda s: s.i % 2 == half)
    both = F.flatten(F.transform(of(0), lambda t: F.transform(F.filter(of(1), lambda b: b.i == t.i + 1), lambda b: F.struct(t.alias("top"), b.alias("bot")))))
    return F.when((F.col("method") == "span") & (F.col("n_names") % 2 == 0), F.get(both, F.lit(0)))


def chosen_pairs(manifest: DataFrame, anchors: DataFrame) -> DataFrame:
    """Span labels with the names of the first (top, bottom) pair of anchors that both exist."""
    labels = placed(manifest.filter("method = 'span'"), anchors).withColumn("pair", _pair()).filter("pair is not null")
    return labels.select("paper_id", "ord", "label_id", "kind", F.col("pair.top.name").alias("top_name"), F.col("pair.bot.name").alias("bot_name"))


def _wrapped() -> tuple:
    """x0, x1, and y0, y1 of wrapped objects, from their two anchors on one page and the measured size. Where the anchors'
    distance differs from the width by over 5 per cent, the width holds."""
    pre, post = F.get("found", F.lit(0)), F.get("found", F.lit(1))
    a, b = pt(pre.x), pt(post.x)
    left, right, width = F.least(a, b), F.greatest(a, b), pt(F.col("width_sp"))
    off = (width > 0) & (F.abs(right - left - width) / F.greatest(width, F.lit(1.0)) > 0.05)
    down = pt(pre.y)
    return left, F.col("height_pt") + (-down - pt(F.col("height_sp"))), F.when(off, left + width).otherwise(right), F.col("height_pt") + (-down + pt(F.col("depth_sp")))


def _spanned() -> tuple:
    """x0, y0, x1, y1 of spans on one page that they touch. x comes from the text block for labels that ask for it
    or cross pages, else from the top anchor and the width of its mark, the column or the text."""
    s, height = F.col("pair"), F.col("height_pt")
    column = F.when(F.col("columnwidth") != 0, F.col("columnwidth")).otherwise(F.col("textwidth"))
    width = F.when(F.col("mark_sp") > 0, pt(F.col("mark_sp"))).otherwise(column)
    block = F.col("use_textblock_x") | (s.top.page != s.bot.page)
    x0 = F.when(block, F.col("text_left")).otherwise(pt(s.top.x))
    top, bot = height - pt(s.top.y), height - pt(s.bot.y)
    upper, lower = F.greatest(F.lit(0.0), F.col("text_top")), F.least(F.col("text_bot"), height)
    at_top, at_bot = F.col("page") == s.top.page, F.col("page") == s.bot.page
    # the anchors' own pages are compared, also where the bottom lies on the earlier one
    y0 = F.when(at_top & at_bot, F.least(top, bot)).when(at_top, top).otherwise(upper)
    y1 = F.when(at_top & at_bot, F.greatest(top, bot)).when(at_top, lower).when(at_bot, bot).otherwise(lower)
    return x0, y0, F.when(block, F.col("text_right")).otherwise(x0 + width), y1


def _boxes_of(labels: DataFrame, pages: DataFrame, boxes: DataFrame | None = None, marks: DataFrame | None = None, page_info: DataFrame | None = None) -> DataFrame:
    """Labels with x0, y0, x1, y1 and height_pt, one row a page they touch: wraps where boxes are given, spans where marks and page_info are. A label
    passes through each join once, whatever its method."""
    pre, post, nothing = F.get("found", F.lit(0)), F.get("found", F.lit(1)), F.lit(False)
    is_wrap = F.coalesce((F.col("method") == "wrap") & (F.col("n_names") == 2) & (F.size("found") == 2) & (pre.page == post.page), nothing)
    j = labels.withColumns({"box_id": F.when(is_wrap, F.col("label_id")), "pair": _pair()}).withColumn("mark_id", F.col("pair.top.name"))
    has_box = has_info = nothing
    if boxes is not None:
        j = j.join(by_paper(boxes).select("paper_id", "box_id", "width_sp", "height_sp", "depth_sp", F.lit(True).alias("has_box")), ["paper_id", "box_id"], "left")
        has_box = F.col("has_box").isNotNull()
    if marks is not None and page_info is not None:
        t = text_block()
        info = by_paper(page_info).select(F.col("paper_id").alias("of_paper"), *[t[n].alias(n) for n in ("text_left", "text_right", "text_top", "text_bot", "columnwidth", "textwidth")], F.lit(True).alias("has_info"))
        j = j.join(by_paper(marks).select("paper_id", "mark_id", F.col("hsize_sp").alias("mark_sp")), ["paper_id", "mark_id"], "left")
        j = j.join(info, (F.col("paper_id") == F.col("of_paper")) & F.col("pair").isNotNull(), "left")
        has_info = F.col("has_info").isNotNull()
    top_page, bot_page = F.col("pair.top.page"), F.col("pair.bot.page")
    touched = F.when(has_box, F.array(pre.page)).when(has_info, F.sequence(F.least(top_page, bot_page), F.greatest(top_page, bot_page)))
    j = j.withColumn("page", F.explode(touched)).join(by_paper(pages).select("paper_id", "page", "height_pt"), ["paper_id", "page"])
    wrapped = _wrapped() if boxes is not None else [F.lit(None)] * 4
    spanned = _spanned() if marks is not None and page_info is not None else [F.lit(None)] * 4
    box = [F.when(has_box, w).otherwise(s).cast("double").alias(v) for w, s, v in zip(wrapped, spanned, ("x0", "y0", "x1", "y1"), strict=True)]
    return j.select("paper_id", "ord", "label_id", "kind", "page", *box, "height_pt", "float_id", "ends")


def wraps(manifest: DataFrame, anchors: DataFrame, boxes: DataFrame, pages: DataFrame) -> DataFrame:
    """Boxes of wrapped objects."""
    return _boxes_of(placed(manifest.filter("method = 'wrap'"), anchors), pages, boxes=boxes).select(*OUT)


def spans(manifest: DataFrame, anchors: DataFrame, marks: DataFrame, page_info: DataFrame, pages: DataFrame) -> DataFrame:
    """Boxes of spans, one a page they touch."""
    return _boxes_of(placed(manifest.filter("method = 'span'"), anchors), pages, marks=marks, page_info=page_info).select(*OUT)


def resolve_labels(manifest: DataFrame, anchors: DataFrame, boxes: DataFrame, marks: DataFrame, page_info: DataFrame, pages: DataFrame) -> DataFrame:
    """Boxes of all labels (OUT), with what union_with_bodies needs of a label: float_id, and cap_y0 and cap_y1 of its own hooks on its page."""
    j = _boxes_of(placed(manifest, anchors, hooks=True), pages, boxes, marks, page_info)
    own = F.transform(F.filter("ends", lambda e: e.page == F.col("page")), lambda e: F.col("height_pt") - pt(e.y))
    return j.select(*OUT, "float_id", F.array_min(own).alias("cap_y0"), F.array_max(own).alias("cap_y1"))


def union_with_bodies(labels: DataFrame) -> DataFrame:
    """Captions widened over the bodies of their float on their page, and over the caption's own anchors. labels: as from resolve_labels.
    Of a float with captions on several pages (or several captions) only the last is widened. A float's labels meet once."""
    is_cap = F.col("kind").endswith("_cap") & F.col("float_id").isNotNull()
    is_body = ~F.col("kind").endswith("_cap") & F.col("float_id").isNotNull()
    of_float, of_page = Window.partitionBy("paper_id", "float_id"), Window.partitionBy("paper_id", "float_id", "page")
    last = F.max(F.when(is_cap, F.struct("ord", "page"))).over(of_float)
    body = lambda f, v: f(F.when(is_body, F.col(v))).over(of_page)
    own = by_paper(labels).withColumns({"last_cap": is_cap & (F.struct("ord", "page") == last), "bx0": body(F.min, "x0"), "by0": body(F.min, "y0"), "bx1": body(F.max, "x1"), "by1": body(F.max, "y1")})
    wide = lambda f, v, *more: F.when(F.col("last_cap"), f(F.col(v), *[F.coalesce(F.col(x), F.col(v)) for x in more])).otherwise(F.col(v)).alias(v)
    return own.select(
        "paper_id", "ord", "label_id", "kind", "page", wide(F.least, "x0", "bx0"), wide(F.least, "y0", "by0", "cap_y0"), wide(F.greatest, "x1", "bx1"), wide(F.greatest, "y1", "by1", "cap_y1")
    )


def cleaned(labels: DataFrame, pages: DataFrame, least: float = 1.0) -> DataFrame:
    """Clipped to the page; boxes under ``least`` square points and on unknown pages go."""
    j = by_paper(labels).join(by_paper(pages).select("paper_id", "page", "width_pt", "height_pt"), ["paper_id", "page"])
    out = j.select("paper_id", "ord", "label_id", "kind", "page", *[clip(F.col(v), F.col(w)).alias(v) for v, w in (("x0", "width_pt"), ("y0", "height_pt"), ("x1", "width_pt"), ("y1", "height_pt"))])
    return out.filter(area(*[F.col(v) for v in ("x0", "y0", "x1", "y1")]) >= least)


def coco_annotations(labels: DataFrame, dpi: int = 200) -> DataFrame:
    """Boxes in pixels with local ids: paper_id, id (from 1 in order), image_id, kind, x, y, w, h, area, label_id."""
    px = {v: pixels(F.col(v), dpi) for v in ("x0", "y0", "x1", "y1")}
    w, h = F.greatest(F.lit(0.0), px["x1"] - px["x0"]), F.greatest(F.lit(0.0), px["y1"] - px["y0"])
    n = F.row_number().over(Window.partitionBy("paper_id").orderBy("ord", "page"))
    return labels.select("paper_id", n.alias("id"), F.col("page").alias("image_id"), "kind", px["x0"].alias("x"), px["y0"].alias("y"), w.alias("w"), h.alias("h"), (w * h).alias("area"), "label_id")


def coco_categories(labels: DataFrame) -> DataFrame:
    """(paper_id, category_id, name): ids from 0 over each paper's sorted kinds."""
    n = F.row_number().over(Window.partitionBy("paper_id").orderBy("kind")) - 1
    return labels.select("paper_id", "kind").distinct().select("paper_id", n.alias("category_id"), F.col("kind").alias("name"))
