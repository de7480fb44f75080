"""Licences of files: sparse TF-IDF cosine of headers and licence files to templates, then inheritance
from the nearest ancestor directory, by DataFrame functions only.

A file is read in lines, and in blocks of neighbouring lines, as notices are wrapped. A line or block
is a notice when its cosine to a template reaches ``SIMILAR``; the file takes its best notice (ties:
the first template by name, the first line, the shortest block). Document frequencies of the
templates' words are counted over all files; a word of no template weighs as one that no file
holds. Numbers and the names of licences and of their terms (``DECISIVE``) must agree: a notice that lacks one of its template, or
holds one of another licence of the family (``FOREIGN``), is rejected, however alike it is. So another version, or "ShareAlike" where
the template has none, is no notice. The sentence that two BSD licences share names both; the file is one of them if its
conditions say so. A file whose name is that of a licence file (LICENSE, COPYING, NOTICE, ... with any ending)
and which has a licence gives it to its directory, and so does, if asked for, one that is little but a notice; files without a notice inherit from the nearest
directory above them that has one, over a join on directories.

A block has no line without words in it. The squares of its lines' norms add up to at most those of
the heaviest template / ``SIMILAR``^2: the dot product is at most the norm of the block's words of the
template, so a heavier block could reach ``SIMILAR`` only by repeating them.

Only lines and blocks with a prefix word of some template are scored. The words of a template that are
no prefix words are its lightest, with squares that add up to less than ``SIMILAR``^2 of the template's;
by Cauchy and Schwarz a text without prefix words has a cosine below ``SIMILAR``.

Defined cases: a null text has no lines; a null path is the root. Null ids are reported like others.
Repeated rows are reported one by one. Without files the result is empty.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from airloom.llm.common import text_of
from airloom.session import materialize

SIMILAR = 0.6
BREAKS = r"[^\p{L}\p{N}]+"
LICENCE_FILE = r"(?i)(^|/)(un)?(licen[cs]e|copying|notice)[^/]*$"

#: Names of licences and the notices that stand for them.
TEMPLATES = (
    ("AGPL-3.0", "This program is licensed under the GNU Affero General Public License, version 3."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("BSD-2-Clause", "Released under the BSD 2-Clause Simplified License."),
    ("BSD-3-Clause", "Released under the BSD 3-Clause License."),
    ("BSD-2-Clause OR BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted"),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC0-1.0", "Released into the public domain under CC0 1.0 Universal."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("ISC", "Released under the ISC License."),
    ("LGPL-3.0", "This library is licensed under the GNU Lesser General Public License, version 3."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License"),
    ("Proprietary", "All rights reserved. Proprietary and confidential."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
)
#: Identifiers of a header line ("SPDX-License-Identifier: ..."), where they differ from the names also those.
IDENTIFIERS = {
    "AGPL-3.0": ("AGPL-3.0-only", "AGPL-3.0-or-later"), "BSD-2-Clause": ("BSD-2-Clause",), "BSD-3-Clause": ("BSD-3-Clause",),
    "CC-BY-4.0": ("CC-BY-4.0",), "CC-BY-NC-4.0": ("CC-BY-NC-4.0",), "CC-BY-SA-4.0": ("CC-BY-SA-4.0",), "CC0-1.0": ("CC0-1.0",),
    "GPL-2.0": ("GPL-2.0-only", "GPL-2.0-or-later"), "GPL-3.0": ("GPL-3.0-only", "GPL-3.0-or-later"), "ISC": ("ISC",),
    "LGPL-3.0": ("LGPL-3.0-only", "LGPL-3.0-or-later"), "MIT": ("MIT",), "MPL-2.0": ("MPL-2.0",), "Unlicense": ("Unlicense",),
}
TEMPLATES += tuple((name, f"SPDX-License-Identifier: {i}") for name, ids in IDENTIFIERS.items() for i in ids)
#: Words, besides numbers, that tell licences apart. A notice needs those of its template.
DECISIVE = frozenset(
    "affero agpl apache bsd cc cc0 creative gnu gpl isc lesser lgpl mit mozilla mpl nc noncommercial proprietary sa sharealike "
    "unlicense".split())
#: By the start of a name, words that a notice of such a licence does not hold unless its template does.
FOREIGN = {
    "CC-BY": ("nc", "noncommercial", "nd", "noderivatives", "noderivs", "sa", "sharealike"), "GPL": ("affero", "agpl", "lesser", "lgpl", "library"),
    "LGPL": ("affero", "agpl"), "AGPL": ("lesser", "lgpl"), "MPL": ("1",),
}


def decisive(words) -> set[str]:
    """Words of a template that a notice must hold."""
    return {w for w in words if w in DECISIVE or w.isdigit()}


def foreign(name: str, words) -> set[str]:
    """Words that a notice of the licence ``name`` by a template of ``words`` must not hold."""
    return {w for start, ws in FOREIGN.items() if name.startswith(start) for w in ws} - set(words)


def _words(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(text), BREAKS, -1), "")


def directory(path: Column) -> Column:
    """Everything before the last slash; "" for the root."""
    return F.regexp_replace(path, r"/?[^/]*$", "")


def prefix_words(weights: dict[str, float], similar: float) -> set[str]:
    """Of a template's words with their weights, those that a text must share one of to reach ``similar``."""
    light = sorted(weights, key=lambda t: (weights[t], t))
    least = similar * similar * (1 - 1e-6) * sum(w * w for w in weights.values())  # rounding errs towards scoring
    held = 0.0
    for n, t in enumerate(light):
        held += weights[t] ** 2
        if held >= least:
            return set(light[n:])
    return set()


def _blocks(each: DataFrame, marked: DataFrame, most: float) -> DataFrame:
    """(uid, line, last): runs of two or more lines with words that weigh ``most`` at most and hold a marked one.

    ``each``: uid, line, term, w; ``marked``: uid, line. Ends of a run lie in the same or the next slice of
    the summed weight, so pairs are only formed of lines that are near each other.
    """
    lines = each.groupBy("uid", "line").agg(F.sum(F.col("w") * F.col("w")).alias("weight"))
    lines = lines.join(marked.withColumn("mark", F.lit(1)), ["uid", "line"], "left")
    order = Window.partitionBy("uid").orderBy("line")
    lines = lines.select(
        "uid", "line", "weight", (F.col("line") - F.row_number().over(order)).alias("run"),
        F.sum("weight").over(order).alias("upto"), F.count("mark").over(order).alias("marks"),
        F.when(F.col("mark").isNotNull(), 1).otherwise(0).alias("mark")).filter(F.col("weight") <= most)
    lines = lines.withColumn("slice", F.floor(F.col("upto") / most))
    first = lines.select(
        "uid", "run", "line", F.explode(F.array("slice", F.col("slice") + 1)).alias("slice"),
        (F.col("upto") - F.col("weight")).alias("before"), (F.col("marks") - F.col("mark")).alias("unmarked"))
    last = lines.select("uid", "run", F.col("line").alias("last"), "slice", "upto", "marks")
    return first.join(last, ["uid", "run", "slice"]).filter(
        (F.col("line") < F.col("last")) & (F.col("upto") - F.col("before") <= most) & (F.col("marks") > F.col("unmarked"))
    ).select("uid", "line", "last")


def notices(files: DataFrame, templates=TEMPLATES, similar: float = SIMILAR) -> DataFrame:
    """(uid, license, score, n_template): the best notice of every file that has one, and the code points of its template.

    ``files``: uid, text."""
    spark = files.sparkSession
    own = spark.createDataFrame([(i, n, t) for i, (n, t) in enumerate(templates)], "template int, license string, text string")
    terms = (
        own.select("template", "license", F.explode(_words(F.col("text"))).alias("term"))
        .groupBy("template", "license", "term").agg(F.count("*").alias("tf"))
    )
    tf: dict[int, dict[str, int]] = {}  # as many as the templates have words
    for r in terms.collect():
        tf.setdefault(r["template"], {})[r["term"]] = r["tf"]
    vocabulary = sorted({t for words in tf.values() for t in words})
    listed = F.array(*map(F.lit, vocabulary))
    rows = files.select("uid", F.lower(text_of("text")).alias("text"))
    total = files.count()
    df = (
        rows.select(F.explode(F.array_intersect(_words(F.col("text")), listed)).alias("term"))
        .groupBy("term").agg(F.count("*").alias("df"))
    )
    found = {r["term"]: r["df"] for r in df.collect()}  # as many rows as the vocabulary at most

    def idf(n: int) -> float:
        return math.log((1 + total) / (1 + n)) + 1

    weights = {i: {t: n * idf(found.get(t, 0)) for t, n in words.items()} for i, words in tf.items()}
    norms = {i: math.sqrt(sum(w * w for w in words.values())) for i, words in weights.items()}
    needed = {i: decisive(words) for i, words in weights.items()}
    barred = {i: foreign(templates[i][0], words) for i, words in weights.items()}
    terms = spark.createDataFrame(
        [(i, templates[i][0], t, w / norms[i], int(t in needed[i]), 0, len(needed[i])) for i, words in weights.items() for t, w in words.items()]
        + [(i, templates[i][0], t, 0.0, 0, 1, len(needed[i])) for i, words in barred.items() for t in sorted(words)],
        "template int, license string, term string, tw double, need int, bar int, needs int")
    weight = F.create_map(*(x for t in vocabulary for x in (F.lit(t), F.lit(idf(found.get(t, 0))))))
    unseen = F.lit(idf(0))
    prefixes = sorted(set().union(*(prefix_words(words, similar) for words in weights.values())))
    prefixes = F.array(*map(F.lit, prefixes))

    def marked(text: str) -> Column:
        return F.arrays_overlap(_words(F.col(text)), prefixes)  # much faster than a pattern of so many words

    lines = rows.filter(marked("text")).select("uid", F.posexplode(F.split("text", "\n", -1)).alias("line", "s"))
    each = materialize(
        lines.select("uid", "line", marked("s").alias("mark"), F.explode(_words(F.col("s"))).alias("term"))
        .groupBy("uid", "line", "mark", "term").agg(F.count("*").alias("tf"))
        .withColumn("w", F.col("tf") * F.coalesce(F.try_element_at(weight, F.col("term")), unseen))
    )
    alone = each.filter("mark").select("uid", "line").distinct()
    blocks = _blocks(each, alone, max(norms.values()) ** 2 / similar ** 2)
    several = (
        blocks.withColumn("at", F.explode(F.sequence("line", "last")))
        .join(each.select("uid", F.col("line").alias("at"), "term", "w"), ["uid", "at"])
        .groupBy("uid", "line", "last", "term").agg(F.sum("w").alias("w"))
    )
    single = each.filter("mark").select("uid", "line", F.col("line").alias("last"), "term", "w")
    spans = materialize(single.unionByName(several))
    long = spans.groupBy("uid", "line", "last").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"))
    dots = (
        spans.join(F.broadcast(terms), "term")  # the templates' words
        .groupBy("uid", "line", "last", "template", "license").agg(
            F.sum(F.col("w") * F.col("tw")).alias("dot"), F.sum("need").alias("need"), F.max("needs").alias("needs"), F.max("bar").alias("bar"))
        .filter("need = needs and bar = 0")
    )
    score = F.round(F.col("dot") / F.col("norm"), 6)
    best = F.max_by(
        F.struct("license", "score", "template"), F.struct("score", -F.col("template"), -F.col("line"), -F.col("last")))
    scored = dots.join(long, ["uid", "line", "last"]).withColumn("score", score).filter(F.col("score") >= similar)
    found = scored.groupBy("uid").agg(best.alias("best")).select("uid", "best.*")
    # Which of the two BSD licences: the third condition forbids to use names, the second is about binary forms.
    telling = rows.filter(F.col("text").contains("promote") | F.col("text").contains("reproduce")).withColumn(
        "text", F.regexp_replace("text", r"[^\p{L}\p{N}]+", " "))
    telling = telling.select(
        "uid", F.col("text").contains("endorse or promote").alias("third"),
        F.col("text").contains("binary form must reproduce").alias("second")).filter("third or second")
    both = F.col("license") == "BSD-2-Clause OR BSD-3-Clause"
    one = F.when(F.col("third"), "BSD-3-Clause").when(F.col("second"), "BSD-2-Clause")
    return found.join(telling, "uid", "left").select(
        "uid", F.coalesce(F.when(both, one), "license").alias("license"), "score",
        F.array(*[F.lit(len(t)) for _, t in templates])[F.col("template")].alias("n_template"))


def scan(
    files: DataFrame, *, id_column: str = "doc_id", path: str | Column = "path", text: str = "text",
    templates=TEMPLATES, similar: float = SIMILAR, little_else: float | None = None,
) -> DataFrame:
    """Per file: id, path, license, score, via ("notice", "inherited" or null).

    Where files have no telling names, ``little_else`` tells licence files by content, too: files with a notice that
    are at most so many times as long as its template."""
    path = F.col(path) if isinstance(path, str) else path
    rows = files.select(F.col(id_column).alias("id"), F.coalesce(path, F.lit("")).alias("path"), F.col(text).alias("text"))
    rows = rows.withColumn("uid", F.monotonically_increasing_id())
    names = materialize(rows.select("uid", "id", "path", F.length(F.trim(text_of("text"))).alias("n_chars")))
    found = materialize(notices(rows.select("uid", "text"), templates, similar))
    named = materialize(names.join(found, "uid", "left").withColumn("dir", directory(F.col("path"))))
    gives = F.col("path").rlike(LICENCE_FILE)
    if little_else is not None:
        gives |= F.col("n_chars") <= little_else * F.col("n_template")
    given = (
        named.filter(F.col("license").isNotNull() & gives)
        .groupBy(F.col("dir").alias("above")).agg(F.max_by("license", F.struct("score", "license")).alias("inherited"))
    )
    # Directories and not files meet the licences, so a directory full of files is one row.
    parts = F.split("dir", "/")
    above = F.transform(F.sequence(F.lit(0), F.size(parts)), lambda n: F.array_join(F.slice(parts, 1, n), "/"))
    near = (
        named.select("dir").distinct().select("dir", F.explode(F.array_distinct(above)).alias("above"))
        .join(given, "above").groupBy("dir").agg(F.max_by("inherited", F.length("above")).alias("inherited"))
    )
    out = named.join(near, "dir", "left")
    via = F.when(F.col("license").isNotNull(), "notice").when(F.col("inherited").isNotNull(), "inherited")
    return out.select(
        F.col("id").alias(id_column), "path", F.coalesce("license", "inherited").alias("license"), "score", via.alias("via"))
