"""Licence scans (operator 7), by DataFrame functions only.

Units of a text are its lines, its blocks between blank lines or lines of comment marks only, and the whole. A unit's sparse TF-IDF vector (words
of ASCII letters and digits, lower-cased, without function words; idf over the templates, the largest idf for words in none)
is compared with each template's by cosine. Before any word is counted, units go whose cosine can't reach the threshold:
those that lack all heavy terms of the templates, and those with too many words that no template has. So nothing is lost.

A notice among other words (a header in a comment, a line of prose) is found by windows over the words of the whole text: from every word
of a template as far as the template is long, and half as far again, cut back to the last word of the template.

One word is no notice: at least two different words are shared ("mit" is a word of German).

A weak template ("All rights reserved.", or the sentence that BSD licences share) names the licence only of a file that no other template matches.

A file whose name says so, or whose whole text matches a template, is a licence file. A file without a match of its own
inherits from the licence file in its directory or the nearest directory above; several in one give the best score, then the first name.
Directories, not files, are joined with licence directories, so a directory with a third of all files is one row there.

Null texts match nothing but may inherit; a null path has no directory and inherits nothing. Null or repeated ids are ids like others. An
empty table gives an empty result.
"""

from __future__ import annotations

import math
import re
from collections import Counter

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from galley.llm.scratch import materialize

# Public licence notices, by SPDX identifier. A licence may have several notices.
TEMPLATES = [
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "SPDX-License-Identifier: MIT"),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "SPDX-License-Identifier: GPL-3.0-only"),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("BSD-3-Clause", "SPDX-License-Identifier: BSD-3-Clause"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("proprietary", "All rights reserved."),
]


def _families() -> list[tuple[str, str]]:
    """Notices of the usual families, each version apart: SPDX lines, short notices, titles and headers."""
    spdx = "SPDX-License-Identifier: "
    out = [("GPL-3.0", spdx + "GPL-3.0-or-later"), ("GPL-3.0", "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007")]
    header = "you can redistribute it and/or modify it under the terms of the GNU {} as published by the Free Software Foundation; either version {} of the License, or (at your option) any later version."
    for name, kind, what, version, date in [
        ("GPL-2.0", "General Public License", "program", "2", "June 1991"), ("LGPL-2.0", "Library General Public License", "library", "2", "June 1991"),
        ("LGPL-2.1", "Lesser General Public License", "library", "2.1", "February 1999"), ("LGPL-3.0", "Lesser General Public License", "library", "3", "29 June 2007"),
        ("AGPL-3.0", "Affero General Public License", "program", "3", "19 November 2007"),
    ]:
        out += [(name, f"{spdx}{name}-only"), (name, f"{spdx}{name}-or-later"), (name, f"GNU {kind} Version {version}, {date}"), (name, f"This work is licensed under the GNU {kind}, version {version}.")]
        out.append((name, f"This {what} is free software; " + header.format(kind, version)))
    out.append(("GPL-2.0", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License version 2 as published by the Free Software Foundation."))
    for kind, title in [("BY", "Attribution"), ("BY-SA", "Attribution-ShareAlike"), ("BY-ND", "Attribution-NoDerivatives"), ("BY-NC", "Attribution-NonCommercial"), ("BY-NC-SA", "Attribution-NonCommercial-ShareAlike"), ("BY-NC-ND", "Attribution-NonCommercial-NoDerivatives")]:
        for v in ("4.0", "3.0"):
            name = f"CC-{kind}-{v}"
            out += [(name, spdx + name), (name, f"Creative Commons {title} {v}")] + [(name, f"Licensed under CC {kind} {v}.")] * (name != "CC-BY-NC-4.0")
    for name, title in [("ISC", "ISC License"), ("BSD-2-Clause", "BSD 2-Clause License"), ("BSD-3-Clause", "BSD 3-Clause License"), ("CC0-1.0", "CC0 1.0 Universal License"), ("0BSD", "BSD Zero Clause License"), ("MPL-2.0", "Mozilla Public License, Version 2.0")]:
        out += [(name, f"Licensed under the {title}.")] + [(name, spdx + name)] * (name != "BSD-3-Clause")
    fee = "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"
    as_is = "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED."
    return out + [
        ("Apache-2.0", "Apache License Version 2.0, January 2004"),
        ("BSD-2-Clause", "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. " + as_is),
        ("BSD-3-Clause", "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."),
        ("ISC", fee + ", provided that the above copyright notice and this permission notice appear in all copies."),
        ("0BSD", fee + ". THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS."),
        ("CC0-1.0", "Creative Commons CC0 1.0 Universal"),
        ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."),
        ("Unlicense", "SPDX-License-Identifier: Unlicense"),
        ("Unlicense", "Released under the Unlicense."),
        ("Unlicense", "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means."),
    ]


TEMPLATES += _families()
# Function words of English, which don't count.
COMMON = frozenset("a an and any are as at be by for from in is it may not of on or other that the this to use was with you".split())
FILE_NAMES = r"(?i)^(licen[cs]e|copying|notice|unlicense)([._-].*)?$"
WORD = "[a-z0-9]+"
# Notices that stand beside those of other licences, or begin several, the weaker the higher.
WEAK = {"Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met": 1, "All rights reserved.": 2}
MARKS = r"[ \t\r/*#;%!\"'<>{}()|=+.-]*"
# Words that open a comment line, and are no words of its text.
OPENERS = r"(?m)^[ \t]*(?:dnl|rem)\b"
# Places are counted in this part of a template's length, so one frame of fixed size serves templates of all lengths (up to 1,000 words).
UNIT = 1 << 20


class Templates:
    """TF-IDF vectors of unit length, the idf of known words and of others, and the heavy terms."""

    def __init__(self, templates: list[tuple[str, str]], threshold: float):
        bags = [Counter(w for w in re.findall(WORD, text.lower()) if w not in COMMON) for _, text in templates]
        n = len(bags)
        df = Counter(w for b in bags for w in b)
        self.idf = {w: math.log((1 + n) / (1 + c)) + 1 for w, c in df.items()}
        self.other = math.log(1 + n) + 1
        self.vectors, self.sizes = [], [sum(b.values()) for b in bags]
        for b in bags:
            v = {w: c * self.idf[w] for w, c in b.items()}
            norm = math.sqrt(sum(x * x for x in v.values()))
            self.vectors.append({w: x / norm for w, x in v.items()})
        # By Cauchy-Schwarz a unit without these terms has a cosine of at most sqrt(left) with any template. Any
        # choice will do; these are few (they serve many templates), and long (few other texts have them)
        left = [1.0] * n
        need = threshold * threshold * 0.999
        heavy: set[str] = set()
        while open_ := [k for k in range(n) if left[k] >= need]:
            gain = Counter()
            for k in open_:
                for w, x in self.vectors[k].items():
                    if w not in heavy:
                        gain[w] += x * x * (1.0 if len(w) >= 5 else 1e-6)
            best = max(gain, key=lambda w: (gain[w], w))
            heavy.add(best)
            for k in range(n):
                left[k] -= self.vectors[k].get(best, 0.0) ** 2
        self.heavy = sorted(heavy)
        # so many different words of a template a window needs at least, be they the heaviest
        self.least = []
        for v in self.vectors:
            mass, k = 0.0, 0
            for x in sorted(v.values(), reverse=True):
                mass, k = mass + x * x, k + 1
                if mass >= need:
                    break
            self.least.append(max(2, k))
        #: The most that one occurrence of a word can add to a dot product with any template.
        self.gain = {w: i * max(v.get(w, 0.0) for v in self.vectors) for w, i in self.idf.items()}

    def square(self, words: Column) -> Column:
        """The squared norm of a unit (its words, sorted)."""
        known = F.create_map(*[x for w, i in self.idf.items() for x in (F.lit(w), F.lit(i))])
        start = F.struct(F.lit("").alias("word"), F.lit(0).alias("run"), F.lit(0.0).alias("square"))

        def step(acc: Column, w: Column) -> Column:
            run = F.when(w == acc["word"], acc["run"] + 1).otherwise(F.lit(1))
            idf = F.coalesce(known[w], F.lit(self.other))
            return F.struct(w.alias("word"), run.alias("run"), (acc["square"] + (2 * run - 1) * idf * idf).alias("square"))

        return F.aggregate(words, start, step)["square"]

    def possible(self, words: Column, threshold: float) -> Column:
        """Whether the cosine of a unit (its words, sorted) with some template can reach the threshold: the sum of gains, which no dot
        product exceeds, is at least threshold times the unit's norm. One pass over the words, no shuffle."""
        known = F.create_map(*[x for w, i in self.idf.items() for x in (F.lit(w), F.struct(F.lit(i).alias("idf"), F.lit(self.gain[w]).alias("gain")))])
        ours = F.filter(words, lambda w: w.isin(*self.idf))
        others = F.filter(words, lambda w: ~w.isin(*self.idf))
        start = F.struct(F.lit("").alias("word"), F.lit(0).alias("run"), F.lit(0.0).alias("square"), F.lit(0.0).alias("gain"))

        def step(acc: Column, w: Column, idf: Column, gain: Column) -> Column:
            # tf squared grows by 2 tf + 1 when a word comes once more
            run = F.when(w == acc["word"], acc["run"] + 1).otherwise(F.lit(1))
            return F.struct(w.alias("word"), run.alias("run"), (acc["square"] + (2 * run - 1) * idf * idf).alias("square"), (acc["gain"] + gain).alias("gain"))

        a = F.aggregate(ours, start, lambda acc, w: step(acc, w, known[w]["idf"], known[w]["gain"]))
        b = F.aggregate(others, start, lambda acc, w: step(acc, w, F.lit(self.other), F.lit(0.0)))
        return a["gain"] >= F.lit(threshold * (1 - 1e-9)) * F.sqrt(a["square"] + b["square"])

    def enough(self, words: Column) -> Column:
        """Whether some template has the words (different ones, of templates) that a window of it needs at least."""
        need = F.array(*[F.struct(F.array(*[F.lit(w) for w in v]).alias("words"), F.lit(k).alias("least")) for v, k in zip(self.vectors, self.least, strict=True)])
        return (F.size(words) >= min(self.least)) & F.exists(need, lambda t: F.size(F.array_intersect(words, t["words"])) >= t["least"])

    def anchored(self, text: Column) -> Column:
        """Whether a lower-case text has a heavy term."""
        return F.arrays_overlap(F.split(text, "[^a-z0-9]+"), F.array(*[F.lit(w) for w in self.heavy]))


def directory(path: Column) -> Column:
    return F.when(F.instr(path, "/") > 0, F.regexp_replace(path, "/[^/]*$", "")).when(path.isNotNull(), F.lit(""))


def passages(scanned: DataFrame, t: Templates, threshold: float) -> DataFrame:
    """row, template, score of the windows over the words (seq) of a text whose cosine reaches the threshold."""
    spark = scanned.sparkSession
    terms = spark.createDataFrame([(w, k, t.sizes[k], t.idf[w], x) for k, v in enumerate(t.vectors) for w, x in v.items()], "word string, template int, size int, idf double, weight double")
    places = (
        scanned.filter("seq is not null").select("row", F.posexplode("seq").alias("at", "word")).join(F.broadcast(terms), "word")
        .withColumn("place", F.floor(F.col("at").cast("bigint") * F.lit(UNIT) / F.col("size")).cast("bigint"))
    )
    order = Window.partitionBy("row", "template").orderBy("place")
    ends = []
    for reach in (UNIT - 500, UNIT * 3 // 2):
        frame = order.rangeBetween(0, reach)
        ends.append(F.struct(F.max("at").over(frame).alias("last"), F.sum(F.col("idf") * F.col("weight")).over(frame).alias("dot"), F.sum(F.col("idf") * F.col("idf")).over(frame).alias("square"), (F.min("word").over(frame) < F.max("word").over(frame)).alias("several")))
    # The norm is at least that of the template's words, each once: a bound without the words between
    found = (
        places.select("row", "template", "at", F.array(*ends).alias("ends")).select("row", "template", "at", F.explode(F.array_distinct("ends")).alias("end"))
        .filter("end.several").filter(F.col("end.dot") >= F.lit(threshold * (1 - 1e-6)) * F.sqrt("end.square"))
        .join(scanned.select("row", "seq"), "row")
        .withColumn("words", F.sort_array(F.slice("seq", F.col("at") + 1, F.col("end.last") - F.col("at") + 1)))
    )
    return found.select("row", "template", F.round(F.col("end.dot") / F.sqrt(t.square(F.col("words"))), 6).alias("score")).filter(F.col("score") >= threshold)


def license_scan(files: DataFrame, path: Column, id_col: str = "doc_id", text_col: str = "text", templates: list[tuple[str, str]] | None = None, threshold: float = 0.75) -> DataFrame:
    """One row a file: doc_id, path, license, score (cosine, 6 places), origin ('own', 'inherited' or null), license_dir."""
    spark = files.sparkSession
    templates = TEMPLATES if templates is None else templates
    t = Templates(templates, threshold)
    # a column of its own, used many times: Spark doesn't inline it, so each text is lower-cased once
    low = files.select(
        F.monotonically_increasing_id().alias("row"), files[id_col].cast("bigint").alias("doc_id"), path.alias("path"), F.lower(F.coalesce(files[text_col], F.lit(""))).alias("text")
    )
    text = F.col("text")
    low = low.withColumn("present", F.when(t.anchored(text), F.array_intersect(F.split(text, "[^a-z0-9]+"), F.array(*[F.lit(w) for w in t.idf]))))
    parts = F.array_distinct(F.concat(F.split(text, "\n"), F.split(text, r"\n[ \t\r]*\n"), F.split(text, rf"\n{MARKS}\n"), F.array(text)))
    split = F.transform(parts, lambda u: F.struct(u.alias("text"), F.sort_array(F.filter(F.split(u, "[^a-z0-9]+"), lambda w: (w != "") & ~w.isin(*COMMON))).alias("words")))
    units = F.filter(split, lambda u: F.arrays_overlap(u["words"], F.array(*[F.lit(w) for w in t.heavy])) & t.possible(u["words"], threshold))
    seq = F.filter(F.split(F.regexp_replace(text, OPENERS, " "), "[^a-z0-9]+"), lambda w: (w != "") & ~w.isin(*COMMON))
    scanned = materialize(
        low.select(
            "row", "doc_id", "path",
            F.when(t.anchored(text), F.transform(units, lambda u: F.struct(u["words"].alias("words"), (u["text"] == text).alias("whole")))).alias("units"),
            F.when(F.coalesce(t.enough(F.col("present")), F.lit(False)), seq).alias("seq"),
        ),
        "notices",
    )
    terms = spark.createDataFrame([(w, k, x) for k, v in enumerate(t.vectors) for w, x in v.items()], "word string, template int, weight double")
    idf = spark.createDataFrame(list(t.idf.items()), "word string, idf double")
    names = spark.createDataFrame([(k, n, WEAK.get(x, 0)) for k, (n, x) in enumerate(templates)], "template int, license string, weak int")
    words = (
        scanned.select("row", F.posexplode("units").alias("unit", "u")).select("row", "unit", "u.whole", F.explode("u.words").alias("word"))
        .groupBy("row", "unit", "whole", "word").agg(F.count(F.lit(1)).alias("tf"))
        .join(F.broadcast(idf), "word", "left").withColumn("w", F.col("tf") * F.coalesce("idf", F.lit(t.other)))
    )  # fmt: skip  # the broadcast tables hold the templates' words only
    norm = words.groupBy("row", "unit", "whole").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"))
    dot = words.join(F.broadcast(terms), "word").groupBy("row", "unit", "template").agg(F.sum(F.col("w") * F.col("weight")).alias("dot"), F.count(F.lit(1)).alias("shared")).filter("shared > 1")
    matched = (
        dot.join(norm, ["row", "unit"]).withColumn("score", F.round(F.col("dot") / F.col("norm"), 6)).filter(F.col("score") >= threshold)
        .select("row", "template", "score", "whole").unionByName(passages(scanned, t, threshold).withColumn("whole", F.lit(False)))
        .join(F.broadcast(names), "template")
        .groupBy("row").agg(F.min(F.struct("weak", (-F.col("score")).alias("minus"), "license")).alias("best"), F.max("whole").alias("whole"))
        .select("row", F.col("best.license").alias("license"), (-F.col("best.minus")).alias("score"), "whole")
    )
    found = materialize(scanned.select("row", "doc_id", "path", directory(F.col("path")).alias("dir")).join(matched, "row", "left"), "matched")
    is_file = F.regexp_extract("path", "([^/]*)$", 1).rlike(FILE_NAMES) | F.coalesce("whole", F.lit(False))
    governed = found.filter(is_file & F.col("license").isNotNull() & F.col("dir").isNotNull()).groupBy("dir").agg(
        F.min(F.struct((-F.col("score")).alias("minus"), F.col("license"))).alias("best")
    ).select(F.col("dir").alias("above"), F.col("best.license").alias("dir_license"), (-F.col("best.minus")).alias("dir_score"))
    parts = F.split("dir", "/")
    above = F.transform(F.sequence(F.lit(0), F.size(parts)), lambda k: F.array_join(F.slice(parts, 1, k), "/"))
    nearest = materialize(
        found.filter("license is null and dir is not null").select("dir").distinct()
        .select("dir", F.posexplode(F.when(F.col("dir") == "", F.array(F.lit(""))).otherwise(above)).alias("depth", "above"))
        .join(governed, "above").groupBy("dir").agg(F.max(F.struct("depth", "above", "dir_license", "dir_score")).alias("near")), "nearest"
    )  # fmt: skip  # written, so that Spark can split the files of a large directory in the last join
    own = F.col("license").isNotNull()
    return found.join(nearest, "dir", "left").select(
        "doc_id", "path",
        F.coalesce("license", F.col("near.dir_license")).alias("license"),
        F.when(own, F.col("score")).otherwise(F.col("near.dir_score")).alias("score"),
        F.when(own, F.lit("own")).when(F.col("near").isNotNull(), F.lit("inherited")).alias("origin"),
        F.when(~own, F.col("near.above")).alias("license_dir"),
    )
