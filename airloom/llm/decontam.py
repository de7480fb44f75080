"""Benchmark passages in documents, found by spaced seeds, by DataFrame functions only.

A mask counts four positions of a window and ignores the others. Every window of a benchmark item
and of a document is hashed under masks, and equal hashes are joined, so a window still hits when
ignored words were substituted. At a hit the item is laid over the document at the hit's offset and
its words are compared one by one (as 64-bit hashes). An offset counts when at least ``LEAST``
words and a quarter of the item's words stand at their place. A document holds an item when, over
all offsets that count, at least ``COVERAGE`` of the item's words (and ``LEAST`` words) do.

Short items need more masks than long ones, which have more windows (``ENOUGH``). Of items with
exactly ``COVERAGE`` of their words at random places, masks find all of up to 10 words and over 98 %
of longer ones (simulated). An item of 64 words or more is laid in parts of 32 to 63 words, each with
its own offsets, so what a hit moves is bounded.

Hits are compared where they are found, in the scan of the documents: only the matched places of offsets
that count, as bits, are shuffled, by document and part. Seeds of a benchmark of any size are broadcast in blocks of
``BROADCAST_SEEDS``, one scan each.

Words are runs of letters and digits, in lower case. An item shorter than ``LEAST`` words is no
evidence and never matches. Items of equal words are one item, named by the smallest id.

Defined cases: null and empty texts and an empty table match nothing; a text of any length is
searched whole. Rows with a null id are never reported. Documents that repeat an id count as one
document. Other columns never matter, also ones named like those used here.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from airloom.llm.common import text_of
from airloom.session import materialize

#: 1: the word counts, 0: it is ignored. Each was the one that, added to those before it, found most
#: of simulated items of 5 to 20 words.
MASKS = ("10111", "111001", "1100101", "1001011", "10100011", "11010001", "10001101", "11000011", "110101",
         "11001001", "10001011", "110010001")
#: Items of this many words or more are sought by this many of the masks.
ENOUGH = ((18, 4), (11, 6), (0, len(MASKS)))
SPAN = max(map(len, MASKS))
LEAST = 5
COVERAGE = 0.6
#: Share of an item's words, or of a part's, at an offset that counts.
OFFSET = 0.25
#: Words of a part of a long item; the last part takes the remainder too.
PART = 32
#: Window hashes of the benchmark that are broadcast at once (about 60 bytes each).
BROADCAST_SEEDS = 1_000_000
#: The benchmark's words are broadcast up to this number (8 bytes each), else joined by a shuffle.
BROADCAST_WORDS = 8_000_000
#: Ids of documents that hold an item are broadcast up to this number (8 bytes each).
BROADCAST_HITS = 1_000_000

BREAKS = r"[^\p{L}\p{N}]+"


def words(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(text), BREAKS, -1), "")


def _hashes(text: Column) -> Column:
    return F.transform(words(text), lambda w: F.xxhash64(w))


def _seed(number: int, at: str) -> Column:
    """Hash of the window of ``hashes`` that starts at ``at``; null where the array ends before it."""
    mask = MASKS[number]
    kept = [F.get("hashes", F.col(at) + k) for k, c in enumerate(mask) if c == "1"]
    return F.when(F.col(at) + len(mask) <= F.size("hashes"), F.xxhash64(F.lit(number), *kept))


def _windows(rows: DataFrame, masks: int) -> DataFrame:
    """The rows once for every place ``at`` of ``hashes`` and every one of the first masks."""
    at = rows.withColumn("at", F.explode(F.sequence(F.lit(0), F.greatest(F.size("hashes") - LEAST, F.lit(0)))))
    return at.select("*", F.posexplode(F.array(*(_seed(m, "at") for m in range(masks)))).alias("mask", "seed"))


def _parts(benchmark: DataFrame, item: str, text: str) -> DataFrame:
    """(part, item, item_words, first, size, hashes): the parts of every different word list, stored."""
    rows = benchmark.select(F.col(item).alias("item"), words(text_of(text)).alias("words"))
    rows = rows.filter(F.col("item").isNotNull() & (F.size("words") >= LEAST)).groupBy("words").agg(F.min("item").alias("item"))
    rows = rows.select("item", F.size("words").alias("item_words"), F.transform("words", lambda w: F.xxhash64(w)).alias("all"))
    last = F.greatest(F.floor(F.col("item_words") / PART).cast("int") - 1, F.lit(0))
    rows = rows.withColumn("last", last).withColumn("i", F.explode(F.sequence(F.lit(0), "last")))
    rows = rows.withColumn("first", F.col("i") * PART)
    size = F.when(F.col("i") < F.col("last"), F.lit(PART)).otherwise(F.col("item_words") - F.col("first"))
    return materialize(rows.withColumn("size", size).select(
        F.monotonically_increasing_id().alias("part"), "item", "item_words", "first", "size",
        F.slice("all", F.col("first") + 1, F.col("size")).alias("hashes")))


def _sought(parts: DataFrame) -> DataFrame:
    """(seed, part, q): the windows of all parts at all their places, stored."""
    masks = reduce(lambda c, e: c.when(F.col("size") >= e[0], e[1]), ENOUGH, F)
    found = _windows(parts.select("part", "size", "hashes"), len(MASKS))
    return materialize(found.filter(F.col("seed").isNotNull() & (F.col("mask") < masks)).select("seed", "part", F.col("at").alias("q")))


def overlaps(
    documents: DataFrame, benchmark: DataFrame, *, id_column: str = "doc_id", text: str = "text",
    item: str = "item_id", item_text: str = "text", coverage: float = COVERAGE,
) -> DataFrame:
    """One row per document and item it holds: id, item, item_words, matched, coverage."""
    parts = _parts(benchmark, item, item_text)
    sought = _sought(parts)
    shortest, all_words = parts.agg(F.min("size"), F.sum("size")).first()
    masks = next(m for least, m in ENOUGH if (shortest or 0) >= least)
    docs = documents.filter(F.col(id_column).isNotNull()).select(F.col(id_column).alias("id"), _hashes(text_of(text)).alias("hashes"))
    blocks = -(-sought.count() // BROADCAST_SEEDS) or 1
    own = parts.withColumnRenamed("hashes", "own")
    own = F.broadcast(own) if (all_words or 0) <= BROADCAST_WORDS else own

    def hits(block: int) -> DataFrame:
        """(id, item, item_words, first, places): matched places of a part as bits, for offsets that count."""
        seeds = sought.filter(F.pmod(F.xxhash64("seed", "part", "q"), F.lit(blocks)) == block) if blocks > 1 else sought
        # The part's place in the document, as far as it lies inside: its words from ``skip`` on.
        met = _windows(docs, masks).join(F.broadcast(seeds), "seed")
        size = F.lit(2 * PART)  # no part is longer
        met = met.select("id", "part", "q", F.greatest(F.col("q") - F.col("at"), F.lit(0)).alias("skip"), F.slice(
            "hashes", F.greatest(F.col("at") - F.col("q"), F.lit(0)) + 1, size).alias("there")).join(own, "part")

        def same(q: Column) -> Column:
            return F.coalesce(F.get("own", q) == F.get("there", q - F.col("skip")), F.lit(False))

        # Where the words from the place before on are equal too, every mask hits there.
        before = reduce(lambda a, b: a & b, (same(F.col("q") + (j - 1)) for j in range(SPAN)))
        places = F.aggregate(
            F.sequence(F.lit(0), F.col("size") - 1), F.lit(0).cast("long"),
            lambda bits, q: bits.bitwiseOR(F.when(same(q), F.call_function("shiftleft", F.lit(1).cast("long"), q)).otherwise(0)))
        laid = met.filter(~before).select("id", "item", "item_words", "first", "size", places.alias("places"))
        n = F.bit_count("places")
        return laid.filter((n >= LEAST) & (n >= OFFSET * F.col("size"))).select("id", "item", "item_words", "first", "places")

    found = reduce(DataFrame.union, (hits(b) for b in range(blocks)))
    found = found.groupBy("id", "item", "item_words", "first").agg(F.bit_count(F.bit_or("places")).alias("n"))
    matched = found.groupBy("id", "item", "item_words").agg(F.sum("n").alias("matched"))
    share = F.col("matched") / F.col("item_words")
    return matched.filter((F.col("matched") >= LEAST) & (share >= coverage)).select(
        F.col("id").alias(id_column), F.col("item").alias(item), F.col("item_words").cast("long").alias("item_words"),
        "matched", share.alias("coverage"))


def clean(documents: DataFrame, benchmark: DataFrame, *, id_column: str = "doc_id", **options) -> DataFrame:
    """The rows of ``documents`` that hold no item."""
    held = materialize(overlaps(documents, benchmark, id_column=id_column, **options).select(id_column).distinct())
    return documents.join(F.broadcast(held) if held.count() <= BROADCAST_HITS else held, id_column, "left_anti").select(*documents.columns)
