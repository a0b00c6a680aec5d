import gzip
import io
import json
import tarfile

from galley.operators import golden
from galley.plans import paper_job
from galley.sources import connect, corpus, sinks


def tar(files, link=None):
    out = io.BytesIO()
    with tarfile.open(fileobj=out, mode="w") as t:
        for name, body in files.items():
            m = tarfile.TarInfo(name)
            m.size = len(body)
            t.addfile(m, io.BytesIO(body))
        if link:
            m = tarfile.TarInfo("l")
            m.type, m.linkname = tarfile.SYMTYPE, link
            t.addfile(m)
    return out.getvalue()


def test_unpacking(spark):
    rows = [
        ("tar", tar({"a/main.tex": b"A", "a/fig.png": b"\x89\0"})), ("gz", gzip.compress(tar({"main.tex": b"B"}))), ("one", gzip.compress(b"\\documentclass{x}")), ("bare", "é text".encode() + b"\xff"),
        ("escape", tar({"../x.tex": b"C"})), ("root", tar({"/etc/x": b"C"})), ("link", tar({"m.tex": b"D"}, "/etc/passwd")), ("junk", b"\0\1\2"), ("none", None), ("big", gzip.compress(b"x" * 50000)),
    ]
    out = connect.unpacked(spark.createDataFrame(rows, "paper_id string, content binary"), most=20000)
    got = {(r.paper_id, r.path): bytes(r.content or b"") for r in out.filter("problem = ''").collect()}
    assert got == {("tar", "a/main.tex"): b"A", ("tar", "a/fig.png"): b"\x89\0", ("gz", "main.tex"): b"B", ("one", "main.tex"): b"\\documentclass{x}", ("bare", "main.tex"): "é text".encode() + b"\xff"}
    bad = {r.paper_id: r.problem for r in out.filter("problem <> ''").collect()}
    assert set(bad) == {"escape", "root", "link", "junk", "none", "big"} and "link" in bad["link"] and "leaves" in bad["escape"]
    assert {r.paper_id: r.text for r in connect.texts(out).collect()}["bare"] == "é text\ufffd"


def test_seeds_and_downloads(spark, tmp_path):
    (tmp_path / "seeds.txt").write_text("# list\n2001.00001  two columns\n2001.00002 # none\n\n2001.00001  two columns\n")
    s = connect.seeds(spark, str(tmp_path / "seeds.txt"))
    assert sorted((r.arxiv_id, r.note) for r in s.collect()) == [("2001.00001", "two columns"), ("2001.00002", "")]
    assert connect.seeds(spark, str(tmp_path / "seeds.txt"), ["2001.00002"]).count() == 1

    def fetch(url):
        if url == "bad":
            raise OSError("gone")
        return url.encode()

    got = connect.downloads(spark.createDataFrame([("a", "u"), ("b", "bad")], "paper_id string, source_url string"), fetch, 2, lambda _: None).collect()
    assert {r.paper_id: bytes(r.content) if r.content else None for r in got} == {"a": b"u", "b": None} and "attempts failed" in {r.paper_id: r.problem for r in got}["b"]


def compiler():
    """A function that workers get by value: they can't import this module."""
    import re

    def fake_compiler(engine, paper, text):
        """Puts each wrapped object and mark on page 1, one below the other, and reports like the macros do."""
        if "broken" in text:
            raise RuntimeError(f"{engine} stops")
        if engine != "xelatex" and "needs xelatex" in text:
            raise RuntimeError("other engine")
        sp, aux, log = 65536, [], []
        if "no geometry" not in text:
            log.append("ARXIVLAYOUT-PAGEINFO paperwidth=614pt paperheight=794pt textwidth=430pt textheight=600pt oddsidemargin=10pt topmargin=0pt headheight=12pt headsep=20pt columnwidth=210pt columnsep=10pt")
        y = 700
        anchor = lambda name, x, y: aux.append(rf"\zref@newlabel{{{name}}}{{\posx{{{x * sp}}}\posy{{{y * sp}}}\abspage{{1}}}}")
        for m in re.finditer(r"\\alxwrap\{([^}]*)\}|\\alxmark(?:left)?\{([^}#]*)\}%", text[text.index(r"\begin{document}") :]):
            y -= 10
            if m[1]:
                log.append(f"ARXIVLAYOUT-BOX id={m[1]} width=100pt height=40pt depth=2pt hsize=210pt")
                anchor(f"{m[1]}-preL", 80, y - 40)
                anchor(f"{m[1]}-postR", 180, y - 40)
                y -= 50
            else:
                log.append(f"ARXIVLAYOUT-MARK id={m[2]} hsize=210.0pt linewidth=210.0pt columnwidth=210.0pt")
                anchor(m[2], 70, y)
        return {"aux": "\n".join(aux), "log": "\n".join(log), "pages": [(612, 792), (612, 792)]}

    return fake_compiler


def test_papers_from_source_to_document(spark, tmp_path):
    doc = lambda body: f"\\documentclass{{a}}\\begin{{document}}{body}\\end{{document}}"
    figure = r"\begin{figure}\includegraphics{x}\caption{F}\end{figure}"
    rows = [
        ("good", "main.tex", doc(r"\input{part}\begin{table}\begin{tabular}{c}1\end{tabular}\caption{T}\end{table}")), ("good", "part.tex", figure),
        ("bad", "main.tex", doc("broken")), ("second", "main.tex", doc("needs xelatex" + figure)), ("blind", "main.tex", doc("no geometry")), ("rest", "notes.tex", "no main file"),
    ]
    built = paper_job.build(spark.createDataFrame(rows, "paper_id string, path string, text string"), compiler())
    out = {r.paper_id: r for r in built.outcomes.collect()}
    assert {k: v.ok for k, v in out.items()} == {"good": True, "bad": False, "second": True, "blind": False, "rest": False}
    assert out["second"].engine == "xelatex" and out["rest"].reason == "no main tex found" and out["blind"].reason == "no PAGEINFO in log"
    assert out["bad"].reason.startswith("compile failed (pdflatex: RuntimeError: pdflatex stops; xelatex")
    assert (s := paper_job.summary(built).first()).papers_ok == 2 and s.labels == out["good"].labels + out["second"].labels
    docs = {r.paper_id: json.loads(r.document) for r in built.documents.collect()}
    names = {c["id"]: c["name"] for c in docs["good"]["categories"]}
    boxes = {names[a["category_id"]]: a["bbox"] for a in docs["good"]["annotations"]}
    assert set(boxes) == {"figure", "figure_cap", "table", "table_cap"} and len(docs["good"]["images"]) == 2
    for kind in ("figure", "table"):  # a caption's box holds its body
        (x, y, w, h), (cx, cy, cw, ch) = boxes[kind], boxes[f"{kind}_cap"]
        assert cx <= x + 0.01 and cy <= y + 0.01 and cx + cw >= x + w - 0.01 and cy + ch >= y + h - 0.01
    summary = json.loads(sinks.run_documents(built.outcomes).first().document)
    assert summary["totals"]["papers"] == 5 and [p["paper_id"] for p in summary["papers"]] == sorted(out)
    # golden snapshots written and read again show no difference, and a moved box shows
    ann = built.annotations.withColumnRenamed("image_id", "page")
    prints = golden.fingerprints(ann, built.images)
    for r in sinks.golden_documents(prints).collect():
        (tmp_path / f"{r.paper_id}.json").write_text(r.document)
    read = corpus.read_golden(spark, str(tmp_path / "*.json"))
    mine = golden.fingerprint_rows(ann)
    assert golden.label_diff(mine, corpus.golden_labels(read)).count() == 0 and golden.header_diff(prints, read).count() == 0
    moved = golden.fingerprint_rows(ann.withColumn("x", ann.x + 9))
    assert {r.problem for r in golden.label_diff(moved, corpus.golden_labels(read)).collect()} == {"bbox"}


def test_images_with_failures(spark):
    pages = spark.createDataFrame([("train", "p", 1, 1000, 500), ("val", "p", 2, 300, 400), ("val", "q", 1, 10, 10)], "split string, paper_id string, page int, width int, height int")

    def render(paper, page, width, height):
        if paper == "q":
            raise ValueError("no file")
        return f"{width}x{height}".encode()

    got = {r.stem: (bytes(r.image or b""), r.problem) for r in connect.emitted(pages, render, 250).collect()}
    assert got["p__page_001"] == (b"500x250", "") and got["p__page_002"] == (b"250x333", "") and got["q__page_001"] == (b"", "ValueError: no file")
