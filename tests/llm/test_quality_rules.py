from __future__ import annotations

import math
import re
from collections import Counter

import pytest

from airloom.llm import quality_rules
from tests.llm.frames import ids, odd_documents, odd_labels

def brute(text):
    text = text or ""
    w = [x for x in re.split(r"[\x20\x09-\x0D]+", text) if x]
    windows = [tuple(w[i:i + 3]) for i in range(len(w) - 2)]
    often = Counter(windows)
    covered = {i + j for i, x in enumerate(windows) if often[x] > 1 for j in range(3)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    failed = len(w) < 50 or 100 * len(covered) > 50 * len(w)
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered), failed


def test_counts_equal_brute_force_and_edges(spark):
    extra = [(20, "a b c a b c\n\n a b c \na b c"), (21, "#*$ %&| <> x\x0by\x0cz\r\nq\xa0r"), (22, "x " * 60), (23, "A\x1cB C"), (24, "\n\n")]
    df = odd_documents(spark, extra)
    rows = quality_rules.judge(df, odd_labels(spark)).collect()
    assert ids(rows) == ids(df.collect())
    texts = {}
    for r in df.collect():
        texts.setdefault(r["doc_id"], set()).add(r["text"])
    for r in rows:
        want = {brute(t) for t in texts[r["doc_id"]]}
        got = tuple(r[c] for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"))
        assert got in want
    carried = quality_rules.judge(df, odd_labels(spark), carry=True)
    assert carried.columns == [*df.columns, "judged_"] and carried.count() == df.count()
    assert quality_rules.judge(df.limit(0), odd_labels(spark).limit(0)).count() == 0


@pytest.mark.parametrize("n,p", [(50, 0.01), (2000, 0.01), (37, 0.3)])
def test_tail_is_the_exact_binomial(spark, n, p):
    rows = spark.createDataFrame([(k, n) for k in range(int(n * p) + 1)], "k long, n long").select(
        "k", quality_rules.tail("k", "n", p).alias("t")).collect()
    for r in rows:
        exact = sum(math.comb(n, i) * p**i * (1 - p)**(n - i) for i in range(r["k"] + 1))
        assert math.isclose(r["t"], exact, rel_tol=1e-9)


def test_cutoffs_keep_their_promise(spark):
    """Bad documents are rejected where a cutoff is certified, and only there."""
    rows = [("en", 1, 1000, 0) for _ in range(3000)] + [("en", 0, 1000, 600) for _ in range(200)]
    rows += [("xx", 1, 1000, 0) for _ in range(20)] + [("xx", 0, 1000, 600) for _ in range(5)]  # too few to certify
    rows += [("yy", 1, 1000, 600) for _ in range(3000)] + [("yy", 0, 1000, 600) for _ in range(200)]  # good ones look alike
    frame = spark.createDataFrame(
        [(s, y, w, 4 * w, n, 0, 0, 10, 0, 0) for s, y, w, n in rows],
        "stratum string, label int, " + ", ".join(f"{c} long" for c in quality_rules.COUNTS))
    got = {r["stratum"]: r.asDict() for r in quality_rules.certify(frame).collect()}
    assert got["en"]["symbols"] == 0.55 and got["en"]["capitals"] is None
    assert got["xx"]["symbols"] is None and got["yy"]["symbols"] is None
