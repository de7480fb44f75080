from __future__ import annotations

import io
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from airloom.llm import token_files
from airloom.llm.queries import QUERIES
from tests.llm.frames import odd_documents
from tests.llm.test_packing import tokenizer

FOLDER = "/root/testdata/sf0.001"


def tokens(text):
    return [*tokenizer().encode(text or "", add_special_tokens=False).ids, 0]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


@settings(max_examples=300, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 2**32 - 1), st.integers(1000, 1100)), min_size=1, max_size=300), st.sampled_from([0.01, 0.5, 0.9, 1.0]))
def test_blocks_round_trip(values, percentile):
    data = token_files.pack_block(np.array(values, np.uint32), percentile)
    assert token_files.unpack_block(data).tolist() == values


def test_width_is_that_of_the_percentile():
    values = np.array([*range(500, 590), *[4_000_000_000] * 10], np.uint32)
    base, n, exceptions, width = token_files._BLOCK_HEAD.unpack_from(token_files.pack_block(values, 0.9))
    assert (base, n, exceptions, width) == (500, 100, 10, 7)
    assert len(token_files.pack_block(values, 0.9)) == token_files._BLOCK_HEAD.size + 10 * 6 + -(-100 * 7 // 8)
    assert token_files._BLOCK_HEAD.unpack_from(token_files.pack_block(np.full(9, 7, np.uint32)))[2:] == (0, 0)


def test_any_run_of_ids_is_read(tmp_path):
    import pyarrow as pa

    rng = np.random.default_rng(5)
    documents = [rng.integers(0, 50_000, n).astype(np.uint32) for n in (1, 0, 3000, 7, 64, 10_000, 5)]
    sink = io.BytesIO()
    writer = token_files.FileWriter(sink, pa.string(), block=64)
    for i, ids in enumerate(documents):
        writer.add(f"d{i}", ids)
    writer.close()
    data, everything = sink.getvalue(), np.concatenate(documents)
    reader = token_files.FileReader(io.BytesIO(data), len(data))
    assert reader.keys.to_pylist() == [f"d{i}" for i in range(7)] and reader.lengths.tolist() == [len(d) for d in documents]
    for a, b in [(0, 0), (0, len(everything)), (63, 65), (64, 128), (len(everything), len(everything))] + [
            sorted(rng.integers(0, len(everything) + 1, 2)) for _ in range(200)]:
        assert reader.ids(int(a), int(b)).tolist() == everything[a:b].tolist()
    for at in (len(data) - 5, len(data) - 60):
        broken = bytearray(data)
        broken[at] ^= 1
        with pytest.raises(ValueError):
            token_files.FileReader(io.BytesIO(bytes(broken)), len(broken))


def test_query_equals_plain_encoding(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()
    want, start = [], 0
    for i, text in sorted((r[0], r[1]) for r in docs):
        ids = tokens(text)
        want.append((i, start, len(ids), crc(ids)))
        start += len(ids)
    got = QUERIES["op13_token_files"](spark, FOLDER)
    assert got.dtypes == [("doc_id", "bigint"), ("start", "bigint"), ("n_tokens", "bigint"), ("ids_crc32", "bigint")]
    assert sorted(map(tuple, got.collect())) == want


def test_odd_rows_and_small_files(spark, tmp_path):
    df = odd_documents(spark, extra=[(-5, "before the others"), (2, "another text"), *[(7, "copy")] * 30])
    kept = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        listed = token_files.write(df, str(tmp_path / "a"), file_ids=100, block=16)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", kept)
    assert listed.count() > 5 and listed.select("part").distinct().count() > 1
    rows = token_files.read(spark, str(tmp_path / "a"), with_ids=True).collect()
    assert sorted((r["doc_id"] is not None, r["doc_id"], r["ids"]) for r in rows if r["doc_id"] is not None) == sorted(
        (True, r["doc_id"], tokens(r["text"])) for r in df.collect() if r["doc_id"] is not None)
    at, last = 0, -10**9
    for r in sorted(rows, key=lambda r: r["start"]):
        i = -10**9 if r["doc_id"] is None else r["doc_id"]
        assert (r["start"], r["n_tokens"], r["ids_crc32"]) == (at, len(r["ids"]), crc(r["ids"])) and i >= last
        at, last = at + r["n_tokens"], i


def test_texts_as_ids_and_empty_table(spark, tmp_path):
    df = spark.createDataFrame([("b", "two words"), ("a", None), (None, "x")], "key string, body string")
    token_files.write(df, str(tmp_path / "a"), id_column="key", text="body", end_id=5)
    got = token_files.read(spark, f"file:{tmp_path}/a", id_column="key", with_ids=True).orderBy("start").collect()
    assert [(r["key"], r["ids"]) for r in got] == [(None, tokens("x")[:-1] + [5]), ("a", [5]), ("b", tokens("two words")[:-1] + [5])]
    token_files.write(df.limit(0), str(tmp_path / "b"), id_column="key", text="body")
    assert token_files.read(spark, str(tmp_path / "b"), id_column="key").count() == 0


def test_files_of_lost_attempts_are_not_read(spark, tmp_path):
    df = spark.createDataFrame([(1, "one"), (2, "two")], "doc_id long, text string")
    token_files.write(df, str(tmp_path / "a"))
    (tmp_path / "a" / "ids-000000-0000-lost.pfor").write_bytes(b"half a file")
    assert token_files.read(spark, str(tmp_path / "a")).count() == 2
