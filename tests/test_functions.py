import hashlib

from pyspark.sql import functions as F

from galley.functions import geometry as G
from galley.functions import text as T


def values(spark, rows, schema, *cols):
    return [tuple(r) for r in spark.createDataFrame(rows, schema).select(*cols).collect()]


def test_split_is_hashlibs(spark):
    stems = [f"p{i}__page_{i % 1200:03d}" for i in range(3000)]

    def plain(s, w):
        b = int.from_bytes(hashlib.sha256(s.encode()).digest()[:8], "big") % sum(w)
        return "train" if b < w[0] else "val" if b < w[0] + w[1] else "test"

    for w in ((8, 1, 1), (1, 1, 8), (7, 2, 1)):
        got = values(spark, [(s,) for s in stems], "s string", T.hash_split(F.col("s"), w))
        assert [r[0] for r in got] == [plain(s, w) for s in stems]
        assert abs(sum(r[0] == "train" for r in got) / len(got) - w[0] / sum(w)) < 0.04


def test_stem_keeps_long_pages(spark):
    assert values(spark, [("p", 7), ("p", 1234)], "p string, n int", T.stem(F.col("p"), F.col("n"))) == [("p__page_007",), ("p__page_1234",)]


def test_six_decimals_are_printfs(spark):
    v = [0.1234565, 0.0000005, 0.9999995, 0.5, 1.0, 0.1234575, 1 / 3]
    assert [r[0] for r in values(spark, [(x,) for x in v], "v double", T.six(F.col("v")))] == ["%.6f" % x for x in v]


def test_slug(spark):
    rows = [("2604.1v1", "A Title: of MANY words and more words", "hep-th"), ("1", "", "hep-th"), ("1", "?!", "cs"), ("1", "x" * 200, "cs")]
    out = [r[0] for r in values(spark, rows, "i string, t string, a string", T.slug(F.col("i"), F.col("t"), F.col("a")))]
    assert out == ["2604.1v1_hepth_a_title_of_many_words_and", "1_hep-th", "1_cs", "1_cs_" + "x" * 40]


def test_dimension(spark):
    raw = ["1pt", " -2.5pt ", "7sp", "0.000007629394531pt", "3cm", "pt", "", "1.2.3pt", "2.5sp", None]
    assert [r[0] for r in values(spark, [(x,) for x in raw], "v string", G.dimension_sp(F.col("v")))] == [65536, -163840, 7, 0, 0, 0, 0, 0, 2, 0]


def test_names(spark):
    row = values(spark, [("http://x/abs/a/abs/2604.1v12", "20xx", "1999-01-01")], "u string, b string, y string", T.id_of_url(F.col("u")), T.without_version(F.lit("2604.1v12")), T.year_of(F.col("b")), T.year_of(F.col("y")), T.date_range(F.lit(2019), F.lit(2022)), T.thousands(F.lit(1234567)), T.base_kind(F.lit("table_cap")), T.base_kind(F.lit("capture")))
    assert row == [("2604.1v12", "2604.1", 0, 1999, "submittedDate:[201901010000 TO 202212312359]", "1,234,567", "table", "capture")]


def test_engines_and_main_file(spark):
    rows = [("main.tex", "\\documentclass{a}\\begin{document} fontspec"), ("a/sample.tex", "\\documentclass{a}\\begin{document} luacode"), ("x.tex", "nothing")]
    got = values(spark, rows, "p string, t string", T.main_file_score(F.col("p"), F.col("t"), F.length("t")), T.engines(F.col("t")), T.engines(F.col("t"), F.lit("pdflatex")))
    assert [r[0] for r in got] == [len(rows[0][1]) + 1000 - 25, len(rows[1][1]) - 50 - 400, None]
    assert [r[1][0] for r in got] == ["xelatex", "lualatex", "pdflatex"] and got[0][2] == ["pdflatex", "xelatex", "lualatex"]


def test_resize_and_columns(spark):
    got = values(spark, [(1700, 2200), (300, 200), (1025, 2051)], "w int, h int", *G.resized(F.col("w"), F.col("h"), 1024))
    assert got == [(1024, 1325), (300, 200), (1024, 2049)]
    assert [G.image_size(s) for s in (0, 100, 720, 1024, 4000)] == [960, 640, 976, 1280, 1280]


def test_label_line_parses(spark):
    got = values(spark, [("3 0.5 0.25 1.0 0.1",), ("x 1 2",), ("",)], "v string", T.parse_yolo(F.col("v")).cls, T.parse_yolo(F.col("v")).nh)
    assert got == [(3, 0.1), (None, None), (None, None)]


def test_class_settings():
    import pytest

    from galley.operators.labels import ClassSettings, gate_classes

    assert ClassSettings(families=("figure", "table")).classes == ("figure", "figure_cap", "table", "table_cap")
    assert ClassSettings(families=("figure", "table"), mode="cap-only").classes == ("figure_cap", "table_cap")
    assert ClassSettings(families=("figure",), mode="box-only").classes == ("figure",)
    got = ClassSettings.read(names=" figure ; table_cap,listing", weights="8:1:1")
    assert got.classes == ("figure", "table_cap", "listing") and got.weights == (8, 1, 1)
    assert gate_classes(("table_cap", "figure", "table")) == ("table", "table_cap", "figure", "figure_cap")
    for bad in ({"names": "figure,figure"}, {"names": "dragon"}, {"names": " ; "}, {"weights": "1:2"}, {"weights": "0:0:0"}, {"weights": "1:-1:1"}, {"mode": "none"}):
        with pytest.raises(ValueError):
            ClassSettings.read(**bad)
