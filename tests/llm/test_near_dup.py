from __future__ import annotations

import collections
import random

import numpy as np
import pytest

from airloom.llm import near_dup
from airloom.llm.components import components
from airloom.llm.queries import QUERIES
from tests.llm.frames import ids, odd_documents

FOLDER = "/root/testdata/sf0.01"


def shingles(text):
    w = (text or "").encode().lower().split()
    return frozenset(b" ".join(w[i:i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()


def brute(docs):
    """id -> smallest id reachable over links, by comparing all pairs that share a shingle."""
    sets = {i: shingles(t) for i, t in docs.items()}
    found = collections.defaultdict(list)
    up = {i: i for i in docs}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for i in sorted(sets):
        met = collections.Counter(j for s in sets[i] for j in found[s])
        for j, n in met.items():
            if 100 * n >= 75 * (len(sets[i]) + len(sets[j]) - n):
                a, b = root(i), root(j)
                up[max(a, b)] = min(a, b)
        for s in sets[i]:
            found[s].append(i)
    return {i: (len(sets[i]), root(i)) for i in docs}


def check(rows, docs):
    want = brute(docs)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in rows}
    assert got == want and all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in rows)


def test_query_equals_brute_force(spark):
    docs = {r[0]: r[1] for r in spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()}
    check(QUERIES["op8_near_duplicates"](spark, FOLDER).collect(), docs)


def test_common_passages_large_groups_and_deep_trees(spark):
    """One passage in every text, a large group of near copies, and nodes that must branch."""
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(5))
    shared = [word() for _ in range(30)]
    base = [word() for _ in range(120)]
    docs = {}
    for i in range(150):  # half of the words shared, yet far from 0.75
        docs[i] = " ".join([*(word() for _ in range(30)), *shared])
    for i in range(200, 330):  # near copies: one or two words changed
        w = list(base)
        for _ in range(rng.randint(0, 2)):
            w[rng.randrange(len(w))] = word()
        docs[i] = " ".join(w)
    for i in range(400, 440):  # pairs near the threshold
        w = docs[i - 400].split()
        w[rng.randrange(len(w))] = word()
        docs[i] = " ".join(w)
    df = spark.createDataFrame(list(docs.items()), "doc_id long, text string")
    check(near_dup.link(df, open_pairs=2).collect(), docs)


def crowd(rng, copies, strays):
    """Near copies of one text, texts that only share a passage with them, and near copies of those."""
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(6))
    base = [word() for _ in range(80)]
    docs = {}
    for i in range(copies):
        w = list(base)
        w[i % 80] = word()
        docs[10 * i] = " ".join(w)
    for i in range(strays):
        w = base[:45] + [word() for _ in range(30)]
        docs[10 * i + 1] = " ".join(w)
        docs[10 * i + 2] = " ".join(w[:-1] + [word()])
    return docs


@pytest.mark.parametrize("estimate", ["all", "none"])
def test_links_without_the_estimate(spark, monkeypatch, estimate):
    """All pairs of nodes are confirmed; then none is, so that the exact join alone finds every link."""
    monkeypatch.setattr(near_dup, "likely", lambda pairs, classes: pairs if estimate == "all" else pairs.limit(0))
    docs = crowd(random.Random(8), 160, 30)
    df = spark.createDataFrame(list(docs.items()), "doc_id long, text string")
    check(near_dup.link(df, open_pairs=8 if estimate == "all" else 0).collect(), docs)


def test_a_large_component_is_not_joined_with_itself(spark):
    """3000 near copies of one component and one other set, all with common rare shingles: 3000 pairs."""
    rng = np.random.default_rng(3)
    base = rng.integers(0, 2**62, 40)
    sets = [(i.to_bytes(4, "big"), np.unique(np.append(base, rng.integers(0, 2**62, 2))).astype(np.int64).tobytes()) for i in range(3001)]
    parts = [(k, b"stray" if k == sets[7][0] else b"group") for k, _ in sets]
    pairs = near_dup.sharing_rare(
        spark.createDataFrame(sets, "k binary, s binary"), spark.createDataFrame(parts, "k binary, c binary"))
    got = {frozenset((bytes(r["a"]), bytes(r["b"]))) for r in pairs.distinct().collect()}
    assert got == {frozenset((k, sets[7][0])) for k, _ in sets if k != sets[7][0]}


def test_edges(spark):
    df = odd_documents(spark)
    rows = near_dup.link(df).collect()
    assert ids(rows) == ids(df.collect())
    of = {r["doc_id"]: r["component_id"] for r in rows}
    assert of[1] == of[2] == 1 and of[6] == of[7] == 6 and of[3] == 3 and of[4] == 4 and of[5] == 5
    assert all(r["kept"] and r["component_id"] is None for r in rows if r["doc_id"] is None)
    left = near_dup.distinct(df)
    assert left.columns == df.columns and ids(left.collect()) == [1, 3, 4, 5, 6, 8, 9, None, None]
    assert near_dup.link(df.limit(0)).count() == 0 and near_dup.distinct(df.limit(0)).count() == 0


def test_repeated_ids_keep_one_row(spark):
    df = spark.createDataFrame([(1, "a b"), (1, "a b"), (1, None), (2, "c d"), (2, "c d")], "doc_id long, text string")
    assert sorted(map(tuple, near_dup.distinct(df).collect())) == [(1, None), (2, "c d")]


def test_minwise_tokens_estimate_similarity():
    rng = np.random.default_rng(2)
    x = rng.integers(0, 2**63, 700).astype(np.uint64)
    a, b = near_dup.signature(np.unique(x[:600])), near_dup.signature(np.unique(x[100:]))
    assert abs((a == b).mean() - 500 / 700) < 0.2


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, i) for i in range(101, 140)] + [(7, 7), (200, 201), (201, 200)]
    got = {r["id"]: r["root"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    want = {i: 0 for i in range(61)} | {i: 100 for i in range(100, 140)} | {200: 200, 201: 200}
    assert got == want
