from __future__ import annotations

import hashlib
import random
import re

import pytest

from airloom.llm import secret_scan as ss
from airloom.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"
ASSIGN = re.compile(
    r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")


def brute(text):
    """The base spans, by three plain regexes over the whole text."""
    out = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m.group(2)) >= 12]
    out += [(m.start(), 1, m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m.group()) >= 18]
    out += [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9a-f]+", text) if len(m.group()) >= 16]
    return sorted(out)


def expected(text):
    spans = brute(text or "")
    joined = ",".join(f"{('assign', 'access', 'hex')[k]}:{a}:{b}" for a, k, b in spans)
    n = [sum(k == i for _, k, _ in spans) for i in range(3)]
    return (*n, hashlib.sha256(joined.encode()).hexdigest(), joined)


def noisy(n, seed=3):
    """Texts of fragments that nearly or really form secrets, some of them not ASCII."""
    rng = random.Random(seed)
    bits = ["password", "PassWd", "ſecret", "secret", "SECRET", "toKen", "api_key", "APIKEY", "Key", '"', "'", " ", "  ",
            ":", "=", "\t", "\n", "AKIA", "AKIAAKIA", "0123456789abcdef", "deadbeef", "ABCDEF0123456789", "é", "日本", "x" * 13,
            "abc.def-ghi_jkl=", "ghp_" + "a1B2" * 9, "-----BEGIN RSA PRIVATE KEY-----", "xoxb-1234567890", "http://u:secretpw@h/"]
    return ["".join(rng.choice(bits) for _ in range(rng.randint(0, 40))) for _ in range(n)]


@pytest.mark.parametrize("pattern,hit,miss", [
    (r"abc(de|fg)h", {b"abc"}, b"zzz"), (r"[Kk]ey=\w+", {b"key", b"ey="}, b"xyz"), (r"ab?c\d", set(), b"abc"),
    (r"(?:foo|bar)baz", {b"baz"}, b"qux"), (r"x+yz", set(), b"xyz"), (r"[0-9a-f]{16,}", set(), b"000"),
])
def test_trigram_queries_are_necessary(pattern, hit, miss):
    query = ss.trigram_query(pattern)
    found = ss._trigrams(query)
    assert hit <= found and miss not in found


def test_every_match_passes_its_query():
    import pyarrow as pa

    texts = pa.array(noisy(3000, 5))
    regexes, queries, wanted, names = ss._compiled(ss.RULES)
    index = ss.Index(texts, wanted, names)
    for regex, query in zip(regexes, queries):
        rows = set(index.find(query).tolist())
        assert {i for i, t in enumerate(texts.to_pylist()) if regex.search(t)} <= rows


def test_spans_equal_brute_force(spark):
    texts = [None, "", *noisy(2000), "password=" + "a" * 300_000, "token=" + "k" * 11, "é" * 70_000 + " secret: abcdefghijkl"]
    df = spark.createDataFrame([(i, t, "clash", 1) for i, t in enumerate(texts)], "doc_id long, text string, spans_ string, _text int")
    got = {r[0]: r for r in ss.digest(ss.scan(df)).collect()}
    assert len(got) == len(texts)
    for i, t in enumerate(texts):
        n_assign, n_access, n_hex, sha, joined = expected(t)
        assert tuple(got[i])[1:5] == (n_assign, n_access, n_hex, sha)
        assert set(joined.split(",")) - {""} <= set(got[i]["spans"].split(","))


def test_query_over_the_whole_table(spark):
    docs = {r[0]: r[1] for r in spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()}
    rows = QUERIES["op3_secret_scan"](spark, FOLDER).collect()
    assert len(rows) == len(docs)
    assert all(tuple(r)[1:5] == expected(docs[r[0]])[:4] for r in rows)


def test_redaction_and_edges(spark):
    schema = "doc_id long, text string, other string"
    rows = [(1, "a token=abcdefghijklmnop b", "x"), (1, "a token=abcdefghijklmnop b", "x"), (None, None, None), (2, "", None), (3, "clean text", "y")]
    out = ss.redact(spark.createDataFrame(rows, schema)).collect()
    assert sorted(map(repr, map(tuple, out))) == sorted(map(repr, [
        (1, "a [assign] b", "x"), (1, "a [assign] b", "x"), (None, None, None), (2, "", None), (3, "clean text", "y")]))
    empty = spark.createDataFrame([], schema)
    assert ss.redact(empty).count() == 0 and ss.digest(ss.scan(empty)).count() == 0
