from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest

from airloom.llm import suffix_dedup
from airloom.llm.induced_sort import suffix_array
from airloom.llm.queries import QUERIES
from tests.llm.frames import odd_documents

FOLDER = "/root/testdata/sf0.001"


def brute(docs, length=100):
    """Rows (n_bytes, n_removed, n_spans, kept_sha256) in the order of ``docs``, all windows in one set."""
    out, seen = [], set()
    for body in docs:
        gone = bytearray(len(body))
        for s in range(len(body) - length + 1):
            w = body[s:s + length]
            if w in seen:
                gone[s:s + length] = b"\1" * length
            seen.add(w)
        kept = bytes(c for c, g in zip(body, gone) if not g)
        spans = sum(1 for i, g in enumerate(gone) if g and not (i and gone[i - 1]))
        out.append((len(body), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


def values(r):
    return r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]


def test_query_equals_brute_force(spark):
    docs = sorted((r[0], r[1].encode()) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect())
    rows = QUERIES["op6_suffix_dedup"](spark, FOLDER).collect()
    want = dict(zip((i for i, _ in docs), brute([b for _, b in docs])))
    assert {r["doc_id"]: values(r) for r in rows} == want and len(rows) == len(docs)


@pytest.mark.parametrize("hot", [4000, 3])
def test_passages_copies_runs_and_hot_anchors(spark, hot):
    rng = random.Random(8)
    word = lambda n: "".join(rng.choice("abcdeé ") for _ in range(n))
    passage, other = word(160), word(99)
    texts = [word(rng.randint(0, 80)) + rng.choice([passage, passage[5:140], other, other + "x", "ab" * 130, "z" * 300, ""]) + word(rng.randint(0, 150))
             for _ in range(60)]
    texts += texts[:8] + ["", "z" * 1000, passage * 4]
    rng.shuffle(texts)
    df = spark.createDataFrame([(i * 3, t) for i, t in enumerate(texts)], "doc_id long, text string")
    rows = {r["doc_id"]: values(r) for r in suffix_dedup.removal(df, hot=hot).collect()}
    assert [rows[i * 3] for i in range(len(texts))] == brute([t.encode() for t in texts])


def test_edges(spark):
    df = odd_documents(spark).filter("doc_id is null or doc_id <> 7")
    rows = suffix_dedup.removal(df).collect()
    order = sorted(df.select("doc_id", "text").collect(), key=lambda r: (r[0] is not None, r[0] or 0, hashlib.sha256((r[1] or "").encode()).hexdigest()))
    want = [(r[0], *v) for r, v in zip(order, brute([(r[1] or "").encode() for r in order]))]
    assert sorted(map(repr, want)) == sorted(repr((r["doc_id"], *values(r))) for r in rows)
    assert suffix_dedup.removal(df.limit(0)).count() == 0


def test_suffix_arrays_with_and_without_spilling():
    rng = random.Random(1)
    for n in range(200):
        s = bytes(rng.choice(b"abz" if n % 2 else b"\x00\xff\x01ab") for _ in range(rng.randint(0, 120))) * rng.choice([1, 3])
        for limit in (1 << 28, 64):
            assert suffix_array(np.frombuffer(s, np.uint8), 400, limit).tolist() == sorted(range(len(s)), key=lambda i: s[i:])
