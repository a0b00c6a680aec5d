import pytest

from galley.functions.geometry import SP_PER_PT
from galley.operators import golden, resolve
from galley.sources import typeset

AUX = r"""
\zref@newlabel{fig_1-preL}{\posx{100}\posy{2000}\abspage{1}}
\zref@newlabel{fig_1-preL}{\posx{6553600}\posy{32768000}\abspage{2}}
\zref@newlabel{fig_1-postR}{\posx{13107200}\posy{32768000}\abspage{2}}
\zref@newlabel{nopos}{\posx{1}\abspage{1}}
\zref@newlabel{nopage}{\posx{-5}\posy{7}}
\zref@newlabel{top}{\posx{1000000}\posy{40000000}\abspage{1}}
\zref@newlabel{bot}{\posx{1000000}\posy{10000000}\abspage{3}}
"""
LOG = """ARXIVLAYOUT-PAGEINFO paperwidth=614.295pt textwidth=400pt textheight=600pt oddsidemargin=bad topmargin=-10pt columnwidth=0pt
ARXIVLAYOUT-PAGEINFO paperwidth=1pt
ARXIVLAYOUT-BOX id=fig_1 width=10pt height=20pt depth=-1.5pt
ARXIVLAYOUT-BOX id=fig_1 width=100pt height=50pt depth=5pt hsize=300pt
ARXIVLAYOUT-MARK id=top hsize=200pt linewidth=1pt columnwidth=2pt
"""


@pytest.fixture(scope="module")
def parsed(spark):
    aux = spark.createDataFrame([("p", AUX), ("q", "")], "paper_id string, text string")
    log = spark.createDataFrame([("p", LOG), ("q", "none")], "paper_id string, text string")
    return typeset.compile_outputs(aux, log)


def test_parse(parsed):
    a = {r.name: (r.posx_sp, r.posy_sp, r.abspage) for r in parsed["anchors"].collect()}
    assert a["fig_1-preL"] == (6553600, 32768000, 2) and a["nopage"] == (-5, 7, 0) and "nopos" not in a
    (i,) = parsed["page_info"].collect()
    assert (i.paperwidth_sp, i.textwidth_sp, i.oddsidemargin_sp, i.topmargin_sp, i.headsep_sp) == (round(614.295 * 65536), 400 * 65536, 0, -655360, 0)
    (b,) = parsed["boxes"].collect()
    assert (b.width_sp, b.depth_sp, b.hsize_sp) == (100 * 65536, 5 * 65536, 300 * 65536)
    assert [r.hsize_sp for r in parsed["marks"].collect()] == [200 * 65536]


def labels(spark, rows):
    return spark.createDataFrame(rows, "paper_id string, ord int, label_id string, kind string, float_id string, anchor_names array<string>, method string, use_textblock_x boolean")


def test_resolve(spark, parsed):
    m = labels(
        spark,
        [
            ("p", 0, "fig_1", "figure", "f", ["fig_1-preL", "fig_1-postR"], "wrap", False),
            ("p", 1, "gone", "figure", "f", ["fig_1-preL", "no"], "wrap", False),
            ("p", 2, "odd", "figure", "f", ["top"], "span", False),
            ("p", 3, "long", "table_cap", "g", ["no", "bot", "top", "bot"], "span", False),
            ("p", 4, "back", "table", "h", ["bot", "top"], "span", False),
        ],
    )
    pages = spark.createDataFrame([("p", n, 600.0, 800.0) for n in (1, 2, 3)], "paper_id string, page int, width_pt double, height_pt double")
    found = resolve.resolve_labels(m, *[parsed[k] for k in ("anchors", "boxes", "marks", "page_info")], pages)
    out = found.collect()
    by = {(r.label_id, r.page): r for r in out}
    assert sorted(by) == [("back", 1), ("back", 2), ("back", 3), ("fig_1", 2), ("long", 1), ("long", 2), ("long", 3)]
    pt = lambda sp: sp / SP_PER_PT
    f = by["fig_1", 2]
    assert (f.x0, f.y1) == pytest.approx((pt(6553600), 800 - pt(32768000) + pt(5 * 65536)))
    assert f.x1 == pytest.approx(pt(13107200))
    top = 72 + pt(-655360)
    bottom = top + pt(600 * 65536)
    assert (by["long", 1].y0, by["long", 1].y1) == pytest.approx((800 - pt(40000000), bottom))
    assert (by["long", 2].y0, by["long", 2].y1) == pytest.approx((max(0, top), bottom))
    assert (by["long", 3].y0, by["long", 3].y1) == pytest.approx((top, 800 - pt(10000000)))
    # the top anchor on the later page: its page goes down to the text's end, the earlier one from its top
    assert (by["back", 3].y0, by["back", 1].y1) == pytest.approx((800 - pt(10000000), 800 - pt(40000000)))
    cleaned = resolve.cleaned(found, pages)
    assert cleaned.filter("x1 > 600 or y1 > 800 or x0 < 0").count() == 0
    coco = resolve.coco_annotations(cleaned).orderBy("id").collect()
    assert [r.id for r in coco] == list(range(1, len(coco) + 1))
    cats = {r.name: r.category_id for r in resolve.coco_categories(cleaned).collect()}
    assert cats == {n: i for i, n in enumerate(sorted(cats))}


def test_caption_hooks_are_found(spark, parsed):
    m = labels(spark, [("p", 0, "c", "table_cap", "f", ["top", "top"], "span", False)])
    hooks = spark.createDataFrame([("p", "alx@cap@bot@c", 0, int(750 * SP_PER_PT), 1), ("p", "alx@cap@top@c", 0, 0, 2), ("p", "alx@cap@top@other", 0, 0, 1)], "paper_id string, name string, posx_sp bigint, posy_sp bigint, abspage bigint")
    pages = spark.createDataFrame([("p", n, 600.0, 800.0) for n in (1, 2)], "paper_id string, page int, width_pt double, height_pt double")
    (r,) = resolve.resolve_labels(m, parsed["anchors"].unionByName(hooks), parsed["boxes"], parsed["marks"], parsed["page_info"], pages).collect()
    assert (r.page, round(r.cap_y0, 3), round(r.cap_y1, 3), r.float_id) == (1, 50, 50, "f")


def test_union_widens_the_last_caption_only(spark):
    lab = spark.createDataFrame(
        [
            ("p", 0, "c", "table_cap", 1, 10.0, 10.0, 20.0, 20.0, "f", 800.0, 800.0), ("p", 0, "c", "table_cap", 2, 10.0, 10.0, 20.0, 20.0, "f", 50.0, 50.0), ("p", 1, "b", "table", 2, 5.0, 12.0, 30.0, 15.0, "f", None, None),
            ("p", 2, "b2", "table", 1, 0.0, 0.0, 99.0, 99.0, "f", None, None), ("p", 3, "l", "listing", 2, 1.0, 1.0, 2.0, 2.0, None, None, None), ("p", 4, "lone", "listing_cap", 2, 1.0, 1.0, 2.0, 2.0, None, 0.0, 9.0),
        ],
        "paper_id string, ord int, label_id string, kind string, page int, x0 double, y0 double, x1 double, y1 double, float_id string, cap_y0 double, cap_y1 double",
    )
    out = {(r.label_id, r.page): (r.x0, r.y0, r.x1, round(r.y1, 3)) for r in resolve.union_with_bodies(lab).collect()}
    assert out.pop(("lone", 2)) == (1, 1, 2, 2)
    assert out["c", 1] == (10, 10, 20, 20) and out["c", 2] == (5, 10, 30, 50) and out["l", 2] == (1, 1, 2, 2) and len(out) == 5


def test_diff_messages(spark):
    schema = "paper_id string, page int, label_id string, kind string, bbox array<int>"
    a = spark.createDataFrame([("p", 1, "a", "figure", [1, 2, 3, 4]), ("p", 1, "x", "figure", [0, 0, 1, 1]), ("p", 2, "k", "table", [9, 9, 9, 9])], schema)
    g = spark.createDataFrame([("p", 1, "a", "figure", [3, 2, 3, 4]), ("p", 1, "m", "figure", [0, 0, 1, 1]), ("p", 2, "k", "figure", [9, 9, 9, 12])], schema)
    got = sorted((r.label_id, r.problem) for r in golden.label_diff(a, g).collect())
    assert got == [("k", "bbox"), ("k", "kind"), ("m", "missing"), ("x", "extra")]


def test_verify(spark):
    files = spark.createDataFrame([("train", "ok", "0 0.1 0.2 0.3 1.0\n7 0 0 1 1\n"), ("train", "empty", " \n"), ("val", "bad", "0 1 2 3\nx 0 0 0 0\n9 0 0 0 0\n0 1.1 0 0 0")], "split string, stem string, text string")
    got = sorted((r.line, r.problem) for r in golden.verify_labels(files, 8).collect())
    assert got == [(1, "bad row"), (2, "parse error"), (3, "class out of range"), (4, "coordinate out of range")]
    images = spark.createDataFrame([("train", "ok"), ("test", "none")], "split string, stem string")
    n, issues, first = golden.verify_summary(images, files, 8)
    assert (n, issues, len(first)) == (2, 5, 5)
