"""Frames that every operator must take: nulls, empty and very long texts, ties, repeated rows, clashing names."""

from __future__ import annotations

ODD_COLUMNS = "doc_id long, text string, lang string, source string, n_chars long, score double, _text int, judged int, spans int, length int"


def odd_documents(spark, extra=()):
    long = " ".join(f"word{i % 977} and{i}" for i in range(40_000))
    texts = [(1, "the same text " * 30), (2, "the same text " * 30), (2, "the same text " * 30), (3, None), (4, ""), (5, " \t\n "),
             (6, long), (7, long + " more"), (None, "text without an id"), (None, None), (8, "one"), (9, "é日本 🙂 ñ"), *extra]
    return spark.createDataFrame([(i, t, None if n % 3 == 0 else "en", "s", 1, 0.5, 1, 2, 3, 4) for n, (i, t) in enumerate(texts)], ODD_COLUMNS)


def odd_labels(spark, rows=((1, 1, 0), (2, 0, 1), (3, 1, 0), (4, 0, 1), (None, 1, 1), (6, None, None), (1, 1, 0), (8, 1, 0), (8, 0, 1))):
    return spark.createDataFrame(list(rows), "doc_id long, quality int, toxic int")


def ids(rows):
    return sorted((r["doc_id"] for r in rows), key=lambda i: (i is None, i))
