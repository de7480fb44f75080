from __future__ import annotations

import math
import random
import re
from collections import defaultdict

import pytest

from airloom.llm import decontam
from airloom.llm.queries import QUERIES
from tests.llm.frames import odd_documents

FOLDER = "/root/testdata/sf0.01"


def test_query_finds_every_passage(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").collect()
    items = spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()
    found = {(r["doc_id"], r["item_id"]) for r in QUERIES["op9_decontamination"](spark, FOLDER).collect()}
    want = {(d["doc_id"], b["item_id"]) for d in docs for b in items if b["text"] in d["text"]}
    assert want <= found and len({d for d, _ in found}) <= 1.1 * len({d for d, _ in want}) + 2


def test_substitutions_cases_and_punctuation(spark):
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(6))
    items = [(i, " ".join(word() for _ in range(n))) for i, n in enumerate([40, 25, 12, 7, 3])] + [(9, None), (None, "a b c d e f g h i j k")]
    items.append((50, items[0][1].upper()))  # equal words: the smaller id names both
    clutter = lambda n: " ".join(word() for _ in range(n))

    def planted(i, swaps=(), sep=" "):
        w = items[i][1].split()
        for s in swaps:
            w[s] = word()
        return f"{clutter(30)} {sep.join(w)} {clutter(20)}"

    docs = [(0, planted(0)), (1, planted(0, [3, 14, 25, 36])), (2, planted(1, [12])), (3, planted(2, sep=", ").upper()),
            (4, planted(3)), (5, planted(4)), (6, clutter(300)), (7, " ".join(items[0][1].split()[:12]) + " " + clutter(50)),
            (8, planted(1) + " " + planted(2)), (None, planted(0))]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]): r["matched"] for r in decontam.overlaps(df, bench).collect()}
    assert got == {(0, 0): 40, (1, 0): 36, (2, 1): 24, (3, 2): 12, (4, 3): 7, (8, 1): 25, (8, 2): 12}
    left = decontam.clean(df, bench).collect()
    assert sorted((r["doc_id"] for r in left), key=str) == [5, 6, 7, None]


def test_edges(spark):
    df = odd_documents(spark)
    bench = spark.createDataFrame([(1, None, 3), (2, "", 3), (3, "the same text the same text the same text the", 3)], "item_id long, text string, words int")
    rows = decontam.overlaps(df, bench).collect()
    assert {(r["doc_id"], r["item_id"]) for r in rows} == {(1, 3), (2, 3)}
    assert decontam.overlaps(df.limit(0), bench).count() == 0 and decontam.overlaps(df, bench.limit(0)).count() == 0
    assert decontam.clean(df, bench).columns == df.columns


def aligned(docs, items):
    """(doc, item) -> matched, by laying every item over every offset of every document."""
    split = lambda t: re.findall(r"[^\W_]+", (t or "").lower())
    named = {}
    for i, t in items:
        w = tuple(split(t))
        if i is not None and len(w) >= 5:
            named[w] = min(i, named.get(w, i))
    held = defaultdict(set)
    for d, t in docs:
        doc = split(t)
        for own, i in named.items():
            last = max(len(own) // 32, 1) - 1
            for shift in range(-len(own), len(doc)):
                parts = defaultdict(set)
                for q, w in enumerate(own):
                    if 0 <= q + shift < len(doc) and doc[q + shift] == w:
                        parts[min(q // 32, last)].add(q)
                for k, places in parts.items():
                    size = 32 if k < last else len(own) - 32 * last
                    if d is not None and len(places) >= max(5, size / 4):
                        held[d, i, len(own)] |= places
    return {(d, i): len(p) for (d, i, n), p in held.items() if len(p) >= 5 and len(p) / n >= 0.6}


def test_recall_at_the_demanded_coverage(spark):
    """Of items of any length with just 60 % of their words left, at random places, over 90 % are found."""
    rng = random.Random(11)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(6))
    items, docs, length = [], [], {}
    for n in (5, 6, 7, 8, 9, 10, 11, 12, 15, 17, 18, 20, 25, 30, 37, 45, 60, 100):
        for _ in range(60):
            w = [word() for _ in range(n)]
            i = len(items)
            items.append((i, " ".join(w)))
            length[i] = n
            for p in rng.sample(range(n), n - max(5, math.ceil(0.6 * n))):
                w[p] = word()
            docs.append((i, " ".join([word() for _ in range(rng.randint(0, 30))] + w + [word() for _ in range(rng.randint(0, 30))])))
    found = decontam.overlaps(
        spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")).collect()
    assert all(r["doc_id"] == r["item_id"] for r in found)
    share = defaultdict(int)
    for r in found:
        share[length[r["item_id"]]] += 1 / 60
    print({n: round(share[n], 3) for n in sorted(set(length.values()))})
    assert all(share[n] >= (0.999 if n <= 9 else 0.9) for n in length.values())


@pytest.mark.parametrize("seeds, words", [(None, None), (300, None), (None, 0)])
def test_equals_plain_alignment(spark, monkeypatch, seeds, words):
    """Repeated windows, insertions, long items in parts and items that stick out; in blocks and by a shuffle, too."""
    if seeds is not None:
        monkeypatch.setattr(decontam, "BROADCAST_SEEDS", seeds)
    if words is not None:
        monkeypatch.setattr(decontam, "BROADCAST_WORDS", words)
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(5))
    phrase = [word() for _ in range(8)]
    lists = [[word() for _ in range(150)], phrase + [word() for _ in range(9)] + phrase, ["ha"] * 12, ["ha"] * 70,
             [word() for _ in range(40)], [word() for _ in range(5)], [word() for _ in range(64)]]
    items = [(i, " ".join(w)) for i, w in enumerate(lists)]
    docs = [(0, " ".join(lists[0])), (1, " ".join(lists[0][30:])), (2, " ".join(["x"] + phrase + lists[1][8:20] + ["y"])),
            (3, " ".join(lists[1][17:] + [word()] * 3)), (4, "ha " * 50), (5, "ha " * 200), (6, "ha ha ha ha"),
            (7, " ".join(lists[4][:17] + [word()] + lists[4][17:])), (8, " ".join(lists[4][:9] + lists[4][20:])),
            (9, " ".join(lists[5])), (10, " ".join(lists[5][:4])), (11, " ".join(lists[6][20:] + lists[0][:100])),
            (11, " ".join(lists[6][:20])), (12, None), (None, " ".join(lists[4]))]
    for i in range(30):
        w = list(rng.choice(lists))
        for p in rng.sample(range(len(w)), int(len(w) * rng.random() * 0.35)):
            w[p] = word()
        docs.append((100 + i, " ".join([word() for _ in range(rng.randint(0, 20))] + w[rng.randint(0, 3):])))
    got = decontam.overlaps(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    got = {(r["doc_id"], r["item_id"]): r["matched"] for r in got.collect()}
    assert got == aligned(docs, items) and len(got) > 30


def test_clashing_columns(spark):
    text = "one two three four five six seven"
    names = ["hashes", "at", "seed", "part", "q", "id", "item", "first", "places"]
    df = spark.createDataFrame([(1, text, *range(9))], ["doc_id", "text", *names])
    bench = spark.createDataFrame([(1, text, *range(9))], ["item_id", "text", *names])
    assert [(r["doc_id"], r["matched"]) for r in decontam.overlaps(df, bench).collect()] == [(1, 7)]
    assert decontam.clean(df, bench).columns == df.columns and decontam.clean(df, bench).count() == 0
