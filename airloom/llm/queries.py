"""The corpus queries, each over its whole table, and the DuckDB SQL of those that SQL can express."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from airloom.llm import (
    conversation_repair, decontam, html_extract, license_scan, near_dup, oracles, packing, prefix_trie, quality_classifier,
    quality_rules, secret_scan, suffix_dedup, token_files, toxicity,
)
from airloom.session import scratch_dir

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def register(fn):
        QUERIES[fn.__name__] = fn
        if sql:
            ORACLE_SQL[fn.__name__] = sql
        return fn

    return register


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


@query(oracles.QUALITY_RULES)
def op10_quality_rules(spark, d):
    judged = quality_rules.judge(table(spark, d, "documents"), table(spark, d, "labels"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines",
                         "n_repeat_words", "base_failed", "kept")


@query()
def op3_secret_scan(spark, d):
    return secret_scan.digest(secret_scan.scan(table(spark, d, "documents").select("doc_id", "text")))


@query()
def op2_best_fit_packing(spark, d):
    return packing.pack(packing.pieces(table(spark, d, "documents")))


@query()
def op1_quality_classifier(spark, d):
    return quality_classifier.classify(table(spark, d, "documents"), table(spark, d, "labels"))


@query()
def op4_toxicity(spark, d):
    return toxicity.classify(table(spark, d, "documents"), table(spark, d, "labels"))


@query(oracles.NEAR_DUPLICATES)
def op8_near_duplicates(spark, d):
    return near_dup.link(table(spark, d, "documents"))


@query(oracles.DECONTAMINATION)
def op9_decontamination(spark, d):
    return decontam.overlaps(table(spark, d, "documents"), table(spark, d, "benchmark"))


@query()
def op5_license_scan(spark, d):
    """Documents lie in folders by source and language. Their names tell nothing, so licence files are those that are
    little but a notice. ``license`` is that of a document's own notice, ``inherited`` that of its folders."""
    path = F.concat_ws("/", "source", "lang", F.col("doc_id").cast("string"))
    found = license_scan.scan(table(spark, d, "documents"), path=path, little_else=2)
    return found.select("doc_id", "path", F.when(F.col("via") == "notice", F.col("license")).alias("license"), "score", "via",
                        F.when(F.col("via") == "inherited", F.col("license")).alias("inherited"))


@query()
def op7_html_extraction(spark, d):
    pages = html_extract.extract(table(spark, d, "pages").select("page_id", "url", "html"))
    return pages.withColumn("n_chars", F.length("text").cast("long"))


@query()
def op6_suffix_dedup(spark, d):
    return suffix_dedup.removal(table(spark, d, "documents"))


@query()
def op13_token_files(spark, d):
    """Writes the files below the shared folder, then reads them back."""
    folder = f"{scratch_dir(spark)}/token-files-{uuid.uuid4().hex}"
    token_files.write(table(spark, d, "documents"), folder)
    return token_files.read(spark, folder)


@query(oracles.CONVERSATION_REPAIR)
def op12_conversation_repair(spark, d):
    damaged = conversation_repair.damage(table(spark, d, "conversations"), "present")
    return conversation_repair.summary(damaged, present="present")


@query(oracles.PREFIX_TRIE)
def op11_prefix_trie(spark, d):
    """Conversations of five share the first turns of the first one."""
    conv = F.col("conv")
    nodes = prefix_trie.trie(table(spark, d, "conversations"), base=conv - conv % 5,
                             head=F.crc32(conv.cast("string").cast("binary")) % 9)
    return nodes.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")
