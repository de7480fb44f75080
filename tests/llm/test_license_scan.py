from __future__ import annotations

import math
import random
import re
from collections import Counter

from pyspark.sql import functions as F

from airloom.llm import license_scan
from airloom.llm.queries import QUERIES
from tests.llm.frames import ids, odd_documents

FOLDER = "/root/testdata/sf0.1"
LINES = {"GNU General Public License, version 3": "GPL-3.0", "CC BY-NC 4.0": "CC-BY-NC-4.0", "the MIT License": "MIT", "Apache License, Version 2.0": "Apache-2.0"}


def test_query_names_every_notice(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").collect()
    want = {d["doc_id"]: next((v for k, v in LINES.items() if k in d["text"]), None) for d in docs}
    got = {r["doc_id"]: r["license"] for r in QUERIES["op5_license_scan"](spark, FOLDER).collect()}
    assert got == want


def test_headers_files_and_nearest_ancestor(spark):
    files = [
        (1, "repo/LICENSE", "Released under the MIT License.\n\nCopyright someone"), (2, "repo/src/a.py", "print(1)"),
        (3, "repo/src/lib/b.py", "# Licensed under the Apache License, Version 2.0.\nx = 1"), (4, "repo/src/lib/c.py", None),
        (5, "repo/src/lib/COPYING.txt", "This work is licensed under the GNU General Public License, version 3."),
        (6, "repo/src/lib/deep/er/d.py", "y"), (7, "other/e.py", "The license of this is not stated anywhere at all, really."),
        (8, None, "no path"), (9, "repository/f.py", "not below repo"), (10, "repo/NOTICE", "nothing to see"),
    ]
    got = {r["doc_id"]: (r["license"], r["via"]) for r in license_scan.scan(
        spark.createDataFrame(files, "doc_id long, path string, text string")).collect()}
    assert got == {
        1: ("MIT", "notice"), 2: ("MIT", "inherited"), 3: ("Apache-2.0", "notice"), 4: ("GPL-3.0", "inherited"), 5: ("GPL-3.0", "notice"),
        6: ("GPL-3.0", "inherited"), 7: (None, None), 8: (None, None), 9: (None, None), 10: ("MIT", "inherited")}


def test_every_template_names_itself(spark):
    rows = [(i, t, n) for i, (n, t) in enumerate(license_scan.TEMPLATES)]
    df = spark.createDataFrame([(i, f"x\n  # {t}\ny", None) for i, t, _ in rows], "doc_id long, text string, path string")
    got = {r["doc_id"]: r["license"] for r in license_scan.scan(df).collect()}
    assert got == {i: n for i, _, n in rows}


def words_of(text):
    return Counter(w for w in re.split(r"[\W_]+", text.lower()) if w)


def best_cosine(text, idf):
    """The highest cosine of any run of neighbouring lines to any template."""
    def length(words):
        return math.sqrt(sum((n * idf(w)) ** 2 for w, n in words.items()))

    lines, best = [words_of(x) for x in text.split("\n")], 0.0
    for i in range(len(lines)):
        for j in range(i, len(lines)):
            if not lines[j]:
                break
            run = sum(lines[i:j + 1], Counter())
            for name, t in license_scan.TEMPLATES:
                t = words_of(t)
                if license_scan.decisive(t) - set(run) or license_scan.foreign(name, t) & set(run):
                    continue
                best = max(best, sum(n * t[w] * idf(w) ** 2 for w, n in run.items()) / length(run) / length(t))
    return best


def test_lines_without_marks_and_wrapped_notices(spark):
    """Every file has its licence by some run of lines, and a file without one has none."""
    texts = {
        "BSD-2-Clause OR BSD-3-Clause": ["Redistribution and use in source and binary forms, with or without",
                         "x = 1\n# Redistribution and\n# use in source and\n# binary forms, with\n# or without\n# modification, are\n# permitted",
                         " * Redistribution and use in source\n * and binary forms, with or without\n * modification, are permitted provided that"],
        "MPL-2.0": ["This Source Code Form is subject to the terms of the Mozilla", "This Source\nCode Form is\nsubject to the\nterms of the Mozilla"],
        "CC-BY-4.0": ["Creative Commons Attribution 4.0 International"], "Apache-2.0": ["SPDX: Apache-2.0"], "BSD-2-Clause": ["BSD 2-Clause Simplified"],
        "MIT": ["Permission is hereby\ngranted, free of\ncharge, to any person\nobtaining a copy"],
        None: ["modification, are permitted", "Redistribution and use\n\nin source and binary", "the\n" * 300, "of the people\nby the people"],
    }
    rows = [(i, t, n) for i, (n, t) in enumerate((n, t) for n, ts in texts.items() for t in ts)]
    df = spark.createDataFrame([(i, t, None) for i, t, _ in rows], "doc_id long, text string, path string")
    got = {r["doc_id"]: r["license"] for r in license_scan.scan(df).collect()}
    assert got == {i: n for i, _, n in rows}


def test_versions_and_terms_must_agree(spark):
    texts = [
        ("SPDX-License-Identifier: MIT", "MIT"), ("SPDX-License-Identifier: GPL-2.0-only", "GPL-2.0"), ("SPDX-License-Identifier: Zlib", None),
        ("// SPDX-License-Identifier: LGPL-2.1-or-later", None), ("SPDX-License-Identifier: LGPL-3.0-or-later", "LGPL-3.0"),
        ("This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.", "CC-BY-SA-4.0"),
        ("This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.", "CC-BY-NC-4.0"),
        ("This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License.", None),
        ("This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License.", None),
        ("Licensed under CC BY 3.0.", None), ("Licensed under CC BY-ND 4.0.", None),
        ("This library is licensed under the GNU Lesser General Public License, version 2.1.", None),
        ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 1.1.", None),
        ("Licensed under the Apache License, Version 1.1.", None), ("All rights reserved.", None),
        ("This program is licensed under the GNU Affero General Public License, version 3.", "AGPL-3.0"),
        ("Redistribution and use in source and binary forms, with or without modification, are permitted", "BSD-2-Clause OR BSD-3-Clause"),
        ("Redistribution and use in source and binary forms, with or without\nmodification, are permitted provided that:\n1. Redistributions of source code"
         "\n2. Redistributions in binary form must\nreproduce the above", "BSD-2-Clause"),
        ("Redistribution and use in source and binary forms, with or without\nmodification, are permitted provided that:\n2. in binary form must reproduce"
         "\n3. Neither the name may be used to endorse or\npromote products", "BSD-3-Clause"),
    ]
    df = spark.createDataFrame([(i, t, None) for i, (t, _) in enumerate(texts)], "doc_id long, text string, path string")
    got = {r["doc_id"]: r["license"] for r in license_scan.scan(df).collect()}
    assert {texts[i][0]: x for i, x in got.items()} == dict(texts)


def test_no_run_of_lines_is_lost(spark):
    """Random pieces of templates, wrapped anywhere: a file has a notice if and only if some run of lines is one."""
    rng = random.Random(8)
    words = sorted({w for _, t in license_scan.TEMPLATES for w in t.split()})
    texts = []
    for _ in range(250):
        t = rng.choice(license_scan.TEMPLATES)[1].split()
        start = rng.randrange(len(t))
        piece = [w for w in t[start:start + rng.randint(1, 14)] if rng.random() < 0.9]
        piece += rng.choices(["other", "words", "here", *words], k=rng.randint(0, 6))
        texts.append("".join(w + rng.choice([" ", " ", " ", "\n", "\n\n" if rng.random() < 0.1 else " "]) for w in piece))
    held, known = Counter(w for t in texts for w in words_of(t)), {w for _, t in license_scan.TEMPLATES for w in words_of(t)}
    best = [best_cosine(t, lambda w: math.log((1 + len(texts)) / (1 + (held[w] if w in known else 0))) + 1) for t in texts]
    got = {r["uid"] for r in license_scan.notices(spark.createDataFrame(list(enumerate(texts)), "uid long, text string")).collect()}
    assert 60 < len(got) < 230 and all(i in got if x > 0.60001 else i not in got for i, x in enumerate(best) if abs(x - 0.6) > 1e-5)


def test_documents_inherit_from_files_that_are_little_but_a_notice(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").withColumn("short", F.length("text") <= 100)
    notice = F.col("short") & F.col("text").rlike("|".join(re.escape(k) for k in LINES))
    path = F.concat_ws("/", "source", "lang", F.when(notice, F.concat(F.lit("LICENSE-"), F.col("doc_id"))).otherwise(F.col("doc_id").cast("string")))
    rows = docs.withColumn("path", path).select("doc_id", "path", "text")
    named = {r["doc_id"]: (r["path"], r["text"]) for r in rows.collect()}
    own = {i: next((v for k, v in LINES.items() if k in t), None) for i, (_, t) in named.items()}
    given = {}
    for i, (p, _) in named.items():
        if "LICENSE" in p:
            given.setdefault(p.rsplit("/", 1)[0], set()).add(own[i])
    got = {r["doc_id"]: r for r in license_scan.scan(rows).collect()}
    assert len(given) >= 3 and sum(r["via"] == "inherited" for r in got.values()) > 50
    for i, (p, _) in named.items():
        near = given.get(p.rsplit("/", 1)[0])
        if own[i]:
            assert (got[i]["license"], got[i]["via"]) == (own[i], "notice")
        else:
            assert got[i]["license"] in near and got[i]["via"] == "inherited" if near else got[i]["license"] is None


def test_documents_of_the_query_inherit(spark, tmp_path):
    """A document that is little but a notice gives its licence to the others of its folder, not one that mentions it."""
    long = "Words of a text that has nothing to do with it. " * 20
    rows = [(1, "Released under the MIT License.\n", "a", "en"), (2, long, "a", "en"), (3, None, "a", "en"), (4, long, "a", "de"),
            (5, long + "\nReleased under the ISC License.", "b", "en"), (6, long, "b", "en"),
            (7, "Licensed under the Apache License, Version 2.0.", "a", "en/old"), (8, long, "a", "en/old/x"), (9, long, None, None)]
    spark.createDataFrame(rows, "doc_id long, text string, source string, lang string").write.parquet(str(tmp_path / "documents.parquet"))
    got = {r["doc_id"]: (r["license"] or r["inherited"], r["via"]) for r in QUERIES["op5_license_scan"](spark, str(tmp_path)).collect()}
    assert got == {1: ("MIT", "notice"), 2: ("MIT", "inherited"), 3: ("MIT", "inherited"), 4: (None, None), 5: ("ISC", "notice"),
                   6: (None, None), 7: ("Apache-2.0", "notice"), 8: ("Apache-2.0", "inherited"), 9: (None, None)}


def test_edges(spark):
    from pyspark.sql import functions as F

    df = odd_documents(spark)
    rows = license_scan.scan(df, path=F.lit("d/x")).collect()
    assert ids(rows) == ids(df.collect()) and all(r["license"] is None for r in rows)
    assert license_scan.scan(df.limit(0), path=F.lit("d/x")).count() == 0
