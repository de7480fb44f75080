"""From raw documents to packed token sequences: five stages, each stored and read again by the next.

Quality rules drop what they reject, one document of each group of near duplicates stays, documents
that hold benchmark passages go, secrets are replaced by their kind, and what is left is packed.

Defined cases: a null or empty text has no words, so the quality rules reject it. Rows with a null id take part in
every stage, but are no one's near duplicate and hold no benchmark passage. Of rows that repeat an id near-duplicate
removal keeps one. Texts of any length are read whole. An empty table gives an empty result. Further columns are
carried up to the packing, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from airloom.llm import decontam, near_dup, packing, quality_rules, secret_scan
from airloom.llm.common import free_name
from airloom.session import materialize


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    judged = free_name(docs, "judged")
    rows = quality_rules.judge(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), carry=True)
    return rows.filter(F.col(f"{judged}.kept")).select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of every component the document with the smallest id stays; of rows that repeat an id, one."""
    return near_dup.distinct(docs)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontam.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    rows = secret_scan.redact(docs)
    return rows.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else rows


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(packing.pieces(docs))


STAGES = [
    ("quality rules", keep_quality),
    ("near duplicates", drop_near_duplicates),
    ("benchmark decontamination", drop_benchmark),
    ("secret scan", redact_secrets),
    ("best-fit packing", pack),
]

#: Near duplicates, redaction and packing are no SQL; tests hold the stages against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
