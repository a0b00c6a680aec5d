import math
import re
from collections import Counter

import duckdb
from pyspark.sql import functions as F

from galley.llm.licenses import COMMON, TEMPLATES, license_scan

bag = lambda t: Counter(w for w in re.findall("[a-z0-9]+", t.lower()) if w not in COMMON)
BAGS = [(n, bag(t)) for n, t in TEMPLATES]
DF = Counter(w for _, b in BAGS for w in b)
IDF = lambda w: math.log((1 + len(BAGS)) / (1 + DF[w])) + 1 if DF[w] else math.log(1 + len(BAGS)) + 1


def cosine(text):
    """The best (score, license) of one unit."""
    a = bag(text)
    va = {w: c * IDF(w) for w, c in a.items()}
    na = math.sqrt(sum(x * x for x in va.values()))
    best = (0, None)
    for name, b in BAGS:
        vb = {w: c * IDF(w) for w, c in b.items()}
        s = round(sum(x * vb.get(w, 0) for w, x in va.items()) / (na * math.sqrt(sum(x * x for x in vb.values()))), 6) if na else 0
        best = max(best, (s, name), key=lambda p: (p[0], [-ord(c) for c in p[1] or ""]))
    return best


def brute(rows, t=0.75):
    own, files = [], {}
    for d, path, text in rows:
        text = text or ""
        scores = [cosine(u) for u in {*text.split("\n"), *re.split(r"\n[ \t\r]*\n", text), text}]
        s, name = max(scores, key=lambda p: p[0])
        own.append((s, name) if s >= t else None)
        if path is not None and s >= t and (re.match(r"(?i)^(licen[cs]e|copying|notice|unlicense)([._-].*)?$", path.split("/")[-1]) or cosine(text)[0] >= t):
            k = path.rpartition("/")[0]
            files[k] = min(files.get(k, (1, "")), (-s, name))
    out = []
    for (d, path, _), o in zip(rows, own, strict=True):
        if o:
            out.append((d, path, o[1], o[0], "own", None))
            continue
        k = path.rpartition("/")[0] if path is not None else None
        while k is not None and k not in files:
            k = k.rpartition("/")[0] if k else None
        out.append((d, path, files[k][1], -files[k][0], "inherited", k) if k is not None else (d, path, None, None, None, None))
    return sorted(out, key=str)


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_edges(spark):
    mit, gpl, apache = TEMPLATES[3][1], TEMPLATES[9][1], TEMPLATES[6][1]
    rows = [
        (1, "a/LICENSE", mit), (2, "a/b/x.py", "print(1)"), (3, "a/b/c/y.py", "# " + apache.replace(". ", ".\n# ")), (4, "a/b/c/z", None),
        (5, "a/b/COPYING.txt", "Foo bar\n\n" + gpl), (6, "q/w", "words only"), (7, None, "no path"), (8, "top", ""), (None, "a/b/n", "x " * 5000 + "\nReleased under the MIT License."),
        (9, "n/whole.txt", "Licensed under CC BY-NC 4.0."), (10, "n/deep/er/f", "text"), (11, "ab/x", "not under a/"), (2, "a/b/x.py", "print(1)"), (12, "a/LICENSE-old", gpl), (13, "LICENSEE/x", "license license license"),
    ]
    df = spark.createDataFrame(rows, "doc_id bigint, path string, text string").withColumn("row", F.lit(1)).withColumn("word", F.lit("c"))
    assert got(license_scan(df, df.path)) == brute(rows)
    assert license_scan(df.filter("false"), df.path).count() == 0


def test_documents(spark):
    p = "/root/testdata/sf0.01/documents.parquet"
    rows = duckdb.sql(f"select doc_id, source || '/' || lang || '/' || doc_id || '.txt', text from '{p}'").fetchall()
    df = spark.read.parquet(p)
    out = got(license_scan(df, F.concat_ws("/", df.source, df.lang, F.concat(df.doc_id.cast("string"), F.lit(".txt")))))
    lines = {d for d, _, t in rows if any(cosine(u)[0] >= 0.75 for u in t.split("\n"))}
    assert lines and lines == {r[0] for r in out if r[4] == "own"} and len(out) == len(rows)


def scan(spark, texts):
    df = spark.createDataFrame([(i, f"d{i}/x.c", t) for i, t in enumerate(texts)], "doc_id bigint, path string, text string")
    return {r.doc_id: (r.license, r.score) for r in license_scan(df, df.path).collect()}


def test_notices_among_other_words(spark):
    gpl = "frob - a tool\nCopyright (C) 2024 A. Person\n\n" + TEMPLATES[9][1].replace(", ", ",\n") + "\n\nThis program is distributed in the hope that it will be useful,\nbut WITHOUT ANY WARRANTY.\n\nYou should have received a copy with it. If not, see the web."
    bsd = "Copyright (c) 2024, Example. All rights reserved.\n\n" + TEMPLATES[13][1] + ":\n\n1. Redistributions of source code must retain the above notice.\nTHIS CODE IS PROVIDED AS IS."
    marked = lambda t, m: "\n".join(m + x for x in t.split("\n"))
    prose = "we took the parser from a friend " * 20
    rows = [
        ("/*\n" + marked(gpl, " * ") + "\n */\nint main() { return 0; }", "GPL-3.0"), (marked(gpl, "dnl "), "GPL-3.0"), (marked(bsd, "// "), "BSD-3-Clause"),
        ("Copyright (c) 2024 Example Corporation. All rights reserved.", "proprietary"), ("Copyright 2020 A. Licensed under the Apache License, Version 2.0.", "Apache-2.0"),
        ("# SPDX-License-Identifier: GPL-3.0-or-later\nimport os", "GPL-3.0"), (prose + "Released under the MIT License. " + prose, "MIT"),
        (prose + "the license of the software is not known, and under any terms we may not use the source " + prose, None),
    ]
    out = scan(spark, [t for t, _ in rows])
    assert [out[i][0] for i in range(len(rows))] == [n for _, n in rows]
    assert out[0][1] == out[1][1] == out[2][1] == out[6][1] == 1


def test_families_are_told_apart(spark):
    gnu = lambda kind, what, v: f"This {what} is free software: you can redistribute it and/or modify\n * it under the terms of the GNU {kind} as published by\n * the Free Software Foundation, either version {v} of the License, or\n * (at your option) any later version.\n"
    bsd = "Copyright (c) 2024, Example.\nAll rights reserved.\n\n" + TEMPLATES[13][1] + ":\n\n1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.\n\n2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.\n\n"
    third = "3. Neither the name of Example Inc. nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.\n\n"
    as_is = "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED."
    fee = "Permission to use, copy, modify, and distribute this software for any purpose with or without fee is hereby granted"
    rows = [
        (gnu("General Public License", "program", "2"), "GPL-2.0"), (gnu("General Public License", "program", "3"), "GPL-3.0"), (gnu("Lesser General Public License", "library", "2.1"), "LGPL-2.1"),
        (gnu("Lesser General Public License", "library", "3"), "LGPL-3.0"), (gnu("Affero General Public License", "program", "3"), "AGPL-3.0"),
        ("GNU GENERAL PUBLIC LICENSE\n   Version 2, June 1991\n", "GPL-2.0"), ("GNU AFFERO GENERAL PUBLIC LICENSE\n   Version 3, 19 November 2007\n", "AGPL-3.0"),
        (bsd + as_is, "BSD-2-Clause"), (bsd + third + as_is, "BSD-3-Clause"), (fee + ", provided that the above copyright notice and this permission notice appear in all copies.", "ISC"),
        ("This is free and unencumbered software released into the public domain.\n\nAnyone is free to copy, modify, publish, use, compile, sell, or\ndistribute this software, either in source code form or as a compiled\nbinary, for any purpose, commercial or non-commercial, and by any\nmeans.", "Unlicense"),
        ("Creative Commons Attribution 4.0", "CC-BY-4.0"), ("This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.", "CC-BY-SA-4.0"),
        ("This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.", "CC-BY-NC-4.0"), ("Licensed under CC BY-NC-SA 4.0.", "CC-BY-NC-SA-4.0"), ("Licensed under CC BY 3.0.", "CC-BY-3.0"),
        ("To the extent possible under law, A. Person has waived all copyright and related or neighboring rights to this work.", "CC0-1.0"),
        ("Der Hund mit dem Ball", None), ("mit", None), ("SPDX-License-Identifier: EUPL-1.2", None), ("SPDX-License-Identifier: Artistic-2.0", None),
    ]
    rows += [(f"// SPDX-License-Identifier: {x}{y}\nint a;", x) for x in ("GPL-2.0", "GPL-3.0", "LGPL-2.1", "LGPL-3.0", "AGPL-3.0") for y in ("-only", "-or-later")]
    rows += [(f"// SPDX-License-Identifier: {x}\nint a;", x) for x in ("MIT", "Apache-2.0", "BSD-2-Clause", "BSD-3-Clause", "ISC", "CC0-1.0", "CC-BY-4.0", "CC-BY-SA-4.0", "CC-BY-NC-4.0", "Unlicense", "MPL-2.0")]
    out = scan(spark, [t for t, _ in rows])
    assert [(rows[i][0], out[i][0]) for i in range(len(rows))] == rows
    # every notice of the table gives its own licence
    out = scan(spark, ["/* " + t + " */ x = 1" for _, t in TEMPLATES])
    assert [out[i][0] for i in range(len(TEMPLATES))] == [n for n, _ in TEMPLATES]


def plain_scan(files, threshold=0.75):
    """The whole query word by word: every unit and window of every text with every template, and directories by walking up."""
    import math
    from collections import Counter

    from galley.llm import licenses as L

    t = L.Templates(L.TEMPLATES, threshold)
    idf = lambda w: t.idf.get(w, t.other)
    words = lambda text: [w for w in re.split("[^a-z0-9]+", text) if w and w not in L.COMMON]
    norm = lambda ws: math.sqrt(sum((c * idf(w)) ** 2 for w, c in Counter(ws).items()))

    def scores(text):
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        units = {*low.split("\n"), *re.split(r"\n[ \t\r]*\n", low), *re.split(rf"\n{L.MARKS}\n", low), low}
        for u in units:
            ws = Counter(words(u))
            for k, v in enumerate(t.vectors):
                if ws and len(set(ws) & set(v)) > 1:
                    yield round(sum(c * idf(w) * v.get(w, 0) for w, c in ws.items()) / norm(list(ws.elements())), 6), k, u == low
        seq = words(re.sub(L.OPENERS, " ", low))
        for k, v in enumerate(t.vectors):
            at = [(i, w, i * L.UNIT // t.sizes[k]) for i, w in enumerate(seq) if w in v]
            for i, _, place in at:
                for reach in (L.UNIT - 500, L.UNIT * 3 // 2):
                    inside = [(j, w) for j, w, p in at if place <= p <= place + reach]
                    if len({w for _, w in inside}) > 1:
                        last = max(j for j, _ in inside)
                        yield round(sum(idf(w) * v[w] for _, w in inside) / norm(seq[i : last + 1]), 6), k, False

    own = {}
    for path, text in files:
        good = [(L.WEAK.get(L.TEMPLATES[k][1], 0), -s, L.TEMPLATES[k][0], whole) for s, k, whole in scores(text) if s >= threshold]
        own[path] = (*min(g[:3] for g in good), any(g[3] for g in good)) if good else None
    governed = {}
    for path, found in own.items():
        folder, _, name = path.rpartition("/")
        if found and (re.match(L.FILE_NAMES, name) or found[3]):
            governed[folder] = min(governed.get(folder, (1.0,)), (found[1], found[2]))
    out = {}
    for path, found in own.items():
        folder = path.rpartition("/")[0]
        if found:
            out[path] = (found[2], -found[1], "own", None)
            continue
        while folder not in governed and folder:
            folder = folder.rpartition("/")[0]
        out[path] = (governed[folder][1], -governed[folder][0], "inherited", folder) if folder in governed else (None, None, None, None)
    return out


def test_query_is_plain_scan(spark):
    """Directories with licence files at several depths, headers in comments, notices in prose, and files without any."""
    import random

    from galley.llm import licenses as L

    rng = random.Random(6)
    filler = "alpha beta gamma delta value return software license version copy notice public source the of and".split()
    prose = lambda n: " ".join(rng.choice(filler) for _ in range(n))
    long_ones = [x for x in L.TEMPLATES if len(x[1].split()) > 12]
    files = [
        ("src/LICENSE", "MIT License\n\n" + L.TEMPLATES[3][1]), ("lib/COPYING", dict((n, x) for n, x in L.TEMPLATES if n == "GPL-3.0")["GPL-3.0"]), ("lib/deep/er/a.txt", prose(30)),
        ("lib/b.txt", None), ("lib/LICENSE.txt", ""), ("other/x.c", "nothing"), ("third/NOTICE", "All rights reserved."), ("third/sub/y.c", "int main"), ("top.c", prose(5)),
        ("mixed/a.c", "/* This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. */\nAll rights reserved.\n"),
    ]
    for i in range(40):
        name, text = rng.choice(L.TEMPLATES if i % 2 else long_ones)
        ws = text.split()
        if i % 4 == 0:
            ws = [w for w in ws if rng.random() > 0.15]
        body = " ".join(ws)
        kind = i % 5
        if kind == 0:
            body = "/*\n * " + "\n * ".join(" ".join(ws[k : k + 8]) for k in range(0, len(ws), 8)) + "\n */\n" + prose(20)
        elif kind == 1:
            body = prose(12) + " " + body + " " + prose(12)
        elif kind == 2:
            body = prose(10) + "\n\n" + body + "\n\n" + prose(10)
        elif kind == 3:
            body = prose(25)
        files.append((f"src/d{i % 7}/{'LICENSE' if i % 10 == 4 else f'f{i}.c'}", body))
    want = plain_scan(dict(files).items())
    df = spark.createDataFrame([(i, p, t) for i, (p, t) in enumerate(dict(files).items())], "doc_id bigint, path string, text string")
    got = {r.path: (r.license, r.score, r.origin, r.license_dir) for r in license_scan(df, df.path).collect()}
    assert {k: v for k, v in got.items() if v != want[k]} == {}
    assert {v[2] for v in got.values()} == {"own", "inherited", None} and got["mixed/a.c"][0] == "MPL-2.0"
