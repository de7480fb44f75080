from __future__ import annotations

import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from airloom.llm import prefix_trie
from airloom.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"
SCHEMA = "conv_id long, turn long, role string, text string"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def plain(rows):
    """Every node, with every member and every node below it listed."""
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            own[conv].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [r[2:] for r in sorted(v, key=lambda r: r[:2])] for c, v in own.items()}
    built = {}
    for c in own:
        base, h = int(c / 5) * 5, zlib.crc32(str(c).encode()) % 9
        built[c] = tuple(own.get(base, [])[:h] + own[c][h:])
    members, ends = defaultdict(list), defaultdict(list)
    for c in sorted(built):
        for d in range(len(built[c]) + 1):
            members[built[c][:d]].append(c)
        ends[built[c]].append(c)
    children = defaultdict(list)
    for k in members:
        if k:
            children[k[:-1]].append(k)
    leaves, saved = {}, {}
    for k in sorted(members, key=len, reverse=True):
        leaves[k] = sum(leaves[x] for x in children[k]) if children[k] else 1
        mine = (len(members[k]) - 1) * len(k[-1][1].encode()) if k else 0
        saved[k] = mine + sum(saved[x] for x in children[k])
    return sorted((m[0], len(k), members[k[:-1]][0] if k else None, len(m), len(children[k]), leaves[k], saved[k],
                   hashlib.sha256(",".join(map(str, ends.get(k, []))).encode()).hexdigest()) for k, m in members.items())


def found(df):
    return sorted(map(tuple, df.select(*COLUMNS).collect()), key=lambda r: (r[0], r[1]))


def nodes(df):
    conv = F.col("conv")
    return prefix_trie.trie(df, base=conv - conv % 5, head=F.crc32(conv.cast("string").cast("binary")) % 9)


@pytest.fixture
def many_tasks(spark):
    kept = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.coalescePartitions.enabled", "spark.sql.shuffle.partitions")}
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "7")
    yield
    for k, v in kept.items():
        spark.conf.set(k, v)


def test_query_equals_plain_trie(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = QUERIES["op11_prefix_trie"](spark, FOLDER)
    assert got.columns == COLUMNS and {t for c, t in got.dtypes if c != "ends_sha256"} == {"bigint"}
    assert found(got) == plain(rows)


def odd_conversations():
    rng = random.Random(4)
    rows = [(1, None, None, None), (1, 0, "user", "a"), (None, 0, "user", "no id"), (2, 5, "", "é日🙂"), (3, 0, "user", "x" * 300_000),
            (-3, 0, "user", "a"), (-3, 1, "assistant", None), (-7, 0, "user", "b"), (7, 0, "user", "only"), (8, 3, "user", "same"), (8, 3, "user", "same")]
    for conv in range(20, 140):  # few different texts, so that much is shared and whole conversations repeat
        rows += [(conv, t, rng.choice(["user", "assistant"]), rng.choice(["", "a", "b", "long text"])) for t in range(rng.choice([1, 2, 3, 9, 12]))]
    return rows


def test_odd_rows(spark, many_tasks):
    rows = odd_conversations()
    df = spark.createDataFrame([(*r, 1, 2, 3) for r in rows], SCHEMA + ", conv int, depth int, cut int")
    assert found(nodes(df)) == plain(rows)


def test_conversation_over_all_tasks_and_hot_copies(spark, many_tasks, monkeypatch):
    monkeypatch.setattr(prefix_trie, "ENDS", 3)
    monkeypatch.setattr(prefix_trie, "HEAVY", 20)  # so that some parents go by broadcast, others by shuffle
    rng = random.Random(9)
    hot = [(41, 100 + t, "user", f"line {rng.randint(0, 5)}") for t in range(2000)]
    twin = [(43, t, r, x) for t, (_, _, r, x) in enumerate(hot[:1500])]
    copies = [(c, t, "user", f"copied {t}") for c in range(200, 500) for t in range(3)]
    rows = odd_conversations() + hot + twin + copies
    df = spark.createDataFrame(rows, SCHEMA)
    assert found(nodes(df)) == plain(rows)


def test_without_heads_nodes_name_their_turn(spark):
    rows = [(5, 0, "user", "a"), (5, 1, "assistant", "b"), (3, 7, "user", "a"), (3, 9, "assistant", "c"), (9, 0, "user", "a")]
    df = spark.createDataFrame(rows, SCHEMA)
    got = {(r["conv_id"], r["depth"]): (r["n_convs"], r["n_leaves"], r["saved_tokens"], r["source_conv"], r["source_place"]) for r in prefix_trie.trie(df).collect()}
    assert got == {(3, 0): (3, 2, 2, None, None), (3, 1): (3, 2, 2, 3, 1), (3, 2): (1, 1, 0, 3, 2), (5, 2): (1, 1, 0, 5, 2)}
    assert nodes(df.limit(0)).count() == 0


def test_hashes_of_a_cut_conversation_add_up(spark):
    import pyarrow as pa

    turns = [(i * 7919).to_bytes(32) for i in range(1, 40)]
    whole = list(_numbers(turns))
    first, second = list(_numbers(turns[:15])), list(_numbers(turns[15:]))
    pieces = pa.Table.from_pylist([{"conv": 1, "part": p, "n": len(x), "total": x[-1]["so_far"], "p1": x[-1]["p1"], "p2": x[-1]["p2"]}
                                   for p, x in ((4, second), (2, first))])
    after = prefix_trie._offsets(None, pieces).to_pylist()[1]
    assert [(after["o1"] + after["w1"] * x["p1"]) % prefix_trie.PRIME for x in second] == [x["p1"] for x in whole[15:]]
    assert (after["n0"], after["total0"]) == (15, 15)


def _numbers(digests):
    import pyarrow as pa
    from unittest import mock

    batch = pa.RecordBatch.from_pydict({"conv": [1] * len(digests), "digest": digests, "bytes": [1] * len(digests)})
    with mock.patch.object(prefix_trie.TaskContext, "get", return_value=mock.Mock(partitionId=lambda: 0)):
        for out in prefix_trie._numbered(iter([batch])):
            yield from out.to_pylist()
