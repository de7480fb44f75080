from __future__ import annotations

import functools
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from airloom.llm import packing
from airloom.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"


@functools.cache
def tokenizer():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(packing.default_tokenizer())
    t.encode_special_tokens = True
    return t


def tokens(text):
    """Ids by the tokenizer itself."""
    t = tokenizer()
    return [*t.encode(text or "", add_special_tokens=False).ids, 2]


def check(rows, docs, capacity=1024):
    """Pieces rebuild the documents and sequences are gapless; returns their number."""
    pieces, places = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r["doc_id"]].append(r)
        places[r["sequence_id"]].append((r["offset"], r["length"]))
    assert set(pieces) == set(docs)
    for i, text in docs.items():
        ids, at = tokens(text), 0
        for n, r in enumerate(sorted(pieces[i], key=lambda r: r["piece"])):
            part = np.array(ids[at:at + r["length"]], "<u4")
            assert (r["piece"], r["start"], r["ids_crc32"]) == (n, at, zlib.crc32(part.tobytes()))
            assert n == 0 or r["length"] == capacity
            at += r["length"]
        assert at == len(ids)
    for parts in places.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= capacity
    return len(places)


def best_fit(lengths, capacity):
    """Best fit, long ones first, item by item."""
    free = []
    for x in sorted(lengths, reverse=True):
        fits = [s for s in free if s >= x]
        if fits:
            free.remove(min(fits))
            free.append(min(fits) - x)
        else:
            free.append(capacity - x)
    return len(free)


@pytest.mark.parametrize("n,low,high", [(1, 1, 1024), (7, 1, 1024), (400, 1, 1024), (300, 1, 60), (300, 300, 700), (300, 600, 1000), (300, 100, 400)])
def test_plan_covers_every_piece_once(n, low, high):
    rng = random.Random(n + low)
    lengths = [rng.randint(low, high) for _ in range(n)] + [1024] * (n // 5) + [333] * (n // 3)
    histogram = Counter(lengths)
    segments, bins = packing.plan(histogram)
    fill, seen = Counter(), Counter()
    for length, a, b, first, per, phase in segments:
        assert a == seen[length]
        seen[length] += b - a
        for r in range(a, b):
            fill[first + (r - a + phase) // per] += length
    assert seen == histogram and max(fill.values()) <= 1024 and len(fill) == bins
    assert bins <= 1.03 * best_fit(lengths, 1024) + 1


def test_query_rebuilds_documents_in_few_sequences(spark):
    docs = {r[0]: r[1] for r in spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()}
    rows = QUERIES["op2_best_fit_packing"](spark, FOLDER).collect()
    n = check(rows, docs)
    assert n <= 1.03 * best_fit([r["length"] for r in rows], 1024) + 1


def test_tokens_equal_the_tokenizer_on_odd_texts():
    encode = packing._encoder(packing.default_tokenizer())
    rng = random.Random(4)
    common = [chr(c) for c in [9, 10, 13, *range(32, 127), *range(0xA0, 0x180), *range(0x2010, 0x2028)]]
    odd = ["日", "本", "​", "　", "🙂", "\x0b", "\x1c", "\x85", "́", "٣", "<|endoftext|>"]
    for n in range(3000):
        letters = common if n % 2 else common + odd
        text = "".join(rng.choice(letters) if rng.random() < 0.6 else rng.choice(" \n 'seab1") for _ in range(rng.randint(0, 60)))
        assert [*encode(text).tolist(), 2] == tokens(text), repr(text)


def test_edges(spark):
    long = "word " * 30_000
    rows = [(1, None, 5), (2, "", 5), (3, long, 5), (4, "same", 5), (5, "same", 5), (None, "no id", 5)]
    df = spark.createDataFrame(rows, "doc_id long, text string, length int")
    out = packing.pack(packing.pieces(df), ranked_rows=2).collect()
    check(out, {r[0]: r[1] for r in rows})
    twice = packing.pack(packing.pieces(df.union(df))).collect()
    assert sorted(r["length"] for r in twice) == sorted([r["length"] for r in out] * 2)
    assert packing.pack(packing.pieces(df.limit(0))).count() == 0
    whole = packing.pieces(df, with_ids=True).filter("doc_id = 3").orderBy("piece").collect()
    assert [i for r in whole for i in r["ids"]] == tokens(long)
