from __future__ import annotations

import corpus_pipeline
from airloom.llm import near_dup
from tests.llm import test_near_dup, test_packing, test_quality_rules, test_secret_scan
from tests.llm.frames import odd_documents

FOLDER = "/root/testdata/sf0.01"


def test_every_stage_against_plain_python(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["quality rules", "near duplicates", "benchmark decontamination", "secret scan", "best-fit packing"]
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{FOLDER}/labels.parquet").collect()}

    kept = corpus_pipeline.materialize(stages["quality rules"](spark, docs, FOLDER))
    left = {r["doc_id"]: r["text"] for r in kept.collect()}
    base = {i for i, t in texts.items() if not test_quality_rules.brute(t)[-1]}
    assert kept.schema == docs.schema and set(left) <= base and all(texts[i] == t for i, t in left.items())
    assert all(labels.get(i) != 1 for i in base - set(left))  # clean documents stay

    single = corpus_pipeline.materialize(stages["near duplicates"](spark, kept, FOLDER))
    want = {i for i, (_, root) in test_near_dup.brute(left).items() if i == root}
    assert single.columns == docs.columns and {r["doc_id"] for r in single.collect()} == want

    clean = corpus_pipeline.materialize(stages["benchmark decontamination"](spark, single, FOLDER))
    items = [r["text"] for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    ids = {r["doc_id"] for r in clean.collect()}
    leaks = {i for i in want if any(b in texts[i] for b in items)}
    assert clean.columns == docs.columns and not ids & leaks and len(want - ids - leaks) <= 2

    safe = corpus_pipeline.materialize(stages["secret scan"](spark, clean, FOLDER))
    rows = {r["doc_id"]: r for r in safe.collect()}
    assert safe.schema == docs.schema and set(rows) == ids
    for i, r in rows.items():
        assert not test_secret_scan.brute(r["text"]) and r["n_chars"] == len(r["text"])
        assert test_secret_scan.brute(texts[i]) or r["text"] == texts[i] or "[" in r["text"]

    packed = stages["best-fit packing"](spark, safe, FOLDER).collect()
    test_packing.check(packed, {i: r["text"] for i, r in rows.items()})


def test_run_takes_odd_rows(spark, tmp_path):
    df = odd_documents(spark)
    df.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, 1)], "doc_id long, quality int").write.parquet(str(tmp_path / "labels.parquet"))
    spark.createDataFrame([(1, None)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    out = corpus_pipeline.run(spark, str(tmp_path))
    assert {r["doc_id"] for r in out.collect()} == {6}
    assert near_dup.distinct(df).count() == 9
