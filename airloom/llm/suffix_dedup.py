"""Removal of every byte covered by a long string that also starts earlier, by sorting suffixes.

1. Equal texts are one text (the copies after the first are covered whole). Of every window of
   ``LENGTH`` bytes the smallest hash among its 16-byte pieces is the anchor; equal windows have
   equal anchors, so a window whose anchor hash occurs once in the corpus has no equal and is
   settled. That leaves the windows of shared anchors, about one run of 35 in 43 bytes each.
2. Runs of windows, with their bytes, go to shards by anchor hash. A shard is worked through in
   pieces of bounded size: their suffixes are put in order by induced sorting (``induced_sort``), in
   which equal windows become neighbours, and in each group of neighbours with a common prefix of
   ``LENGTH`` bytes all but the earliest are covered.
3. The runs of an anchor with more than ``HOT`` occurrences are spread over several shards. What is
   earliest in one shard is compared with the other shards' by a digest per window, whose minimum
   Spark takes with partial aggregation; no anchor, however hot, meets in one task.

Earlier means: a smaller id, or the same text and a smaller start. Texts that share an id are
ordered by their digests; a null id is smaller than others. A null text is empty. Of repeated rows
one is the first and the others are copies. An empty table gives no rows. Only id and text are read,
so other columns and their names never matter.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from airloom.llm.common import bounded_batches, chunks, text_of
from airloom.llm.induced_sort import suffix_array
from airloom.llm.near_dup import mix
from airloom.session import materialize

LENGTH = 100
PIECE = 16
HOT = 4000
#: Bytes of runs that are sorted together.
SORTED_BYTES = 2 << 20
#: Bytes of text whose anchors are looked for together; positions must fit 24 bits.
ANCHOR_BYTES = 8 << 20
#: Texts up to this number are picked by a broadcast of their keys (two numbers each), else by a shuffle.
BROADCAST_KEYS = 1_000_000

_U = np.uint64


def anchors(text: np.ndarray, length: int = LENGTH) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, first window, last window) of the runs of windows that share an anchor, in order."""
    n = len(text) - length + 1
    if n < 1:
        return (np.zeros(0, np.int64),) * 3
    words = np.lib.stride_tricks.as_strided(text, (len(text) - 7, 8), (1, 1)).copy().view(np.uint64).ravel()
    with np.errstate(over="ignore"):
        h = mix(words[:-8] * _U(0x9E3779B97F4A7C15) + mix(words[8:]))
    low = (h >> _U(24) << _U(24)) | np.arange(len(h), dtype=np.uint64)  # ties: the leftmost
    span, width = length - PIECE + 1, 1
    while 2 * width <= span:
        low = np.minimum(low[:-width], low[width:])
        width *= 2
    low = np.minimum(low[: n], low[span - width: span - width + n])
    at = (low & _U((1 << 24) - 1)).astype(np.int64)
    first = np.flatnonzero(np.append(True, at[1:] != at[:-1]))
    return h[at[first]].view(np.int64), first, np.append(first[1:] - 1, n - 1)


def _texts(documents: DataFrame, id_column: str, text: str) -> DataFrame:
    """(ord, sha, body): the place of the id, the digest, the bytes."""
    body = text_of(text).cast("binary")
    place = F.coalesce(F.col(id_column).cast("bigint"), F.lit(-(1 << 63)).cast("bigint"))
    return documents.select(place.alias("ord"), F.sha2(body, 256).alias("sha"), body.alias("body"))


def _key(sha: str) -> Column:
    """64 bits of the digest; with the place of the id they name a text."""
    return F.conv(F.substring(sha, 1, 15), 16, 10).cast("bigint")


KEY = "ord bigint, d bigint"


def find_anchors(texts: DataFrame, length: int = LENGTH) -> DataFrame:
    """(ord, d, h, first, last) of all runs of windows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, "body", ANCHOR_BYTES // 4):
            rows, found, held = [], [], 0
            for i, body in enumerate(batch.column("body")):
                raw = np.frombuffer(body.as_buffer(), np.uint8)
                for start in range(0, max(1, len(raw) - length + 1), ANCHOR_BYTES):
                    part = raw[start: start + ANCHOR_BYTES + length - 1]
                    h, first, last = anchors(np.ascontiguousarray(part), length)
                    rows.append(np.full(len(h), i))
                    found.append((h, first + start, last + start))
                    held += len(h)
                if held > 200_000 or i == batch.num_rows - 1:
                    row = pa.array(np.concatenate(rows))
                    yield pa.RecordBatch.from_arrays(
                        [batch.column("ord").take(row), batch.column("d").take(row),
                         *(pa.array(np.concatenate(x).astype(np.int64)) for x in zip(*found))], names=["ord", "d", "h", "first", "last"])
                    rows, found, held = [], [], 0

    bounded_batches(texts.sparkSession)
    return texts.select("ord", "d", "body").mapInArrow(run, f"{KEY}, h bigint, first bigint, last bigint")


def _runs_with_bytes(texts: DataFrame, length: int) -> DataFrame:
    """(ord, d, runs, body) -> one row per run with its bytes. ``runs``: structs h, salts, first, last."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, "body"):
            lists = batch.column("runs")
            bodies = batch.column("body").to_pylist()
            row_of = np.repeat(np.arange(batch.num_rows), pa.compute.list_value_length(lists).to_numpy())
            h, salts, first, last = lists.flatten().flatten()
            begin, end = first.to_numpy(), last.to_numpy() + length
            # Pieces of about four megabytes.
            cuts = np.flatnonzero(np.diff(np.cumsum(end - begin) >> 22)) + 1
            for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(row_of)]):
                rows = row_of[a:b]
                pieces = [bodies[i][x:y] for i, x, y in zip(rows.tolist(), begin[a:b].tolist(), end[a:b].tolist())]
                at = pa.array(rows)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("ord").take(at), batch.column("d").take(at), h[a:b], salts[a:b], first[a:b], pa.array(pieces, pa.binary())],
                    names=["ord", "d", "h", "salts", "first", "bytes"])

    return texts.mapInArrow(run, f"{KEY}, h bigint, salts int, first bigint, bytes binary")


COVERED = f"{KEY}, first bigint, last bigint, digest binary"


def sort_piece(table: pa.Table, length: int) -> pa.Table:
    """Of runs of windows: the covered windows as ranges, and for runs of hot anchors the windows
    that are earliest here, with digests.

    Runs are laid out by (ord, d, first), so a smaller position in the text is an earlier start.
    """
    o, d, first = (table.column(c).to_numpy() for c in ("ord", "d", "first"))
    order = np.lexsort((first, d, o))
    o, d, first = o[order], d[order], first[order]
    again = np.append(False, (o[1:] == o[:-1]) & (d[1:] == d[:-1]) & (first[1:] == first[:-1]))
    order, o, d, first = (x[~again] for x in (order, o, d, first))  # a row that was read twice
    rows = table.column("bytes").combine_chunks().take(pa.array(order)).to_pylist()
    # Runs that equal an earlier one are covered whole and need no sorting.
    seen: set[bytes] = set()
    fresh = np.array([not (b in seen or seen.add(b)) for b in rows], bool)
    late = {"ord": o[~fresh], "d": d[~fresh], "first": first[~fresh], "last": first[~fresh] + np.array(
        [len(b) - length for b, new in zip(rows, fresh) if not new], np.int64), "digest": [None] * int((~fresh).sum())}
    order, o, d, first = (x[fresh] for x in (order, o, d, first))
    rows = [b for b, new in zip(rows, fresh) if new]
    hot = (table.column("salts").to_numpy() > 1)[order]
    sizes = np.array([len(b) for b in rows])
    starts = np.cumsum(sizes) - sizes
    raw = np.frombuffer(b"".join(rows), np.uint8)
    run_of = np.repeat(np.arange(len(rows)), sizes)
    inside = np.arange(len(raw)) - starts[run_of]
    is_window = inside <= sizes[run_of] - length
    sa = suffix_array(raw, length)
    sa = sa[is_window[sa]].astype(np.int64)
    same = np.ones(max(0, len(sa) - 1), bool)
    padded = np.append(raw, np.zeros(8, np.uint8))
    words = np.lib.stride_tricks.as_strided(padded, (len(raw) + 1, 8), (1, 1))
    left = np.arange(len(same))
    for at in [*range(0, length - 7, 8), length - 8]:  # the common prefix of neighbours, up to ``length``
        equal = (words[sa[left] + at].copy().view(np.uint64) == words[sa[left + 1] + at].copy().view(np.uint64)).ravel()
        same[left[~equal]] = False
        left = left[equal]
    heads = np.flatnonzero(np.append(True, ~same)) if len(sa) else np.zeros(0, np.int64)
    earliest = np.minimum.reduceat(sa, heads) if len(sa) else sa
    covered = np.ones(len(raw), bool) & is_window
    covered[earliest] = False
    # Ranges of covered windows, run by run.
    edge = np.flatnonzero(covered & ~(np.append(False, covered[:-1]) & (inside > 0)))
    end = np.flatnonzero(covered & ~(np.append(covered[1:], False) & (np.append(inside[1:], 0) > 0)))
    out = {"ord": o[run_of[edge]], "d": d[run_of[edge]], "first": first[run_of[edge]] + inside[edge], "last": first[run_of[edge]] + inside[end],
           "digest": [None] * len(edge)}
    lead = earliest[hot[run_of[earliest]]] if len(sa) else earliest
    blob = raw.tobytes()
    extra = {"ord": o[run_of[lead]], "d": d[run_of[lead]], "first": first[run_of[lead]] + inside[lead], "last": first[run_of[lead]] + inside[lead],
             "digest": [hashlib.blake2b(blob[p: p + length], digest_size=16).digest() for p in lead.tolist()]}
    schema = pa.schema([("ord", pa.int64()), ("d", pa.int64()), ("first", pa.int64()), ("last", pa.int64()), ("digest", pa.binary())])
    return pa.concat_tables([pa.table(x, schema=schema) for x in (late, out, extra)])


def _sort_shards(runs: DataFrame, length: int) -> DataFrame:
    """Sorts the runs of every shard, several anchors at a time; ``runs`` come sorted by (h, salt)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size = 0
        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(batch)
            size += batch.column("bytes").nbytes
            if size < SORTED_BYTES:
                continue
            table = pa.Table.from_batches(held)
            h, s = table.column("h").to_numpy(), table.column("salt").to_numpy()
            cut = np.flatnonzero((h[1:] != h[:-1]) | (s[1:] != s[:-1])) + 1  # the last anchor may go on
            if len(cut):
                yield from sort_piece(table.slice(0, int(cut[-1])), length).to_batches()
                table = table.slice(int(cut[-1]))
            held, size = table.to_batches(), table.column("bytes").nbytes
        if held:
            yield from sort_piece(pa.Table.from_batches(held), length).to_batches()

    return runs.mapInArrow(run, COVERED)


def _shared(found: DataFrame, hot: int) -> DataFrame:
    """The runs whose anchor occurs more than once, with its ``count``.

    Counts are summed before they are shuffled. Anchors with more than a ten-thousandth of all runs, fewer than ten
    thousand of them, are joined by broadcast; any other one has few rows enough to be joined by a shuffle.
    """
    counts = materialize(found.groupBy("h").count().filter("count > 1"))
    limit = max(hot, found.count() // 10_000)
    frequent = F.broadcast(counts.filter(F.col("count") > limit))
    rest = found.join(frequent.select("h"), "h", "left_anti").join(counts.filter(F.col("count") <= limit), "h")
    return rest.unionByName(found.join(frequent, "h"))


def covered_windows(documents: DataFrame, *, id_column: str, text: str, length: int = LENGTH, hot: int = HOT) -> tuple[DataFrame, DataFrame]:
    """(rows, windows). Rows: ord, sha, n, m (times the row occurs), origin (the first id of that
    text). Windows: (ord, d, first, last), ranges of starts of covered windows of first texts."""
    texts = _texts(documents, id_column, text)
    rows = texts.groupBy("ord", "sha", F.octet_length("body").cast("bigint").alias("n")).agg(F.count("*").alias("m"))
    rows = materialize(rows)
    origin = materialize(rows.groupBy("sha").agg(F.min("ord").alias("origin"), F.count("*").alias("ids")))
    rows = materialize(rows.join(origin.drop("ids"), "sha"))
    copies = rows.filter("ord <> origin").select("ord", _key("sha").alias("d"))
    few = copies.count() <= BROADCAST_KEYS
    single = texts.withColumn("d", _key("sha")).join(F.broadcast(copies) if few else copies, ["ord", "d"], "left_anti")
    found = materialize(find_anchors(single, length))
    shared = materialize(_shared(found, hot).select(
        "ord", "d", F.struct("h", F.ceil(F.col("count") / hot).cast("int").alias("salts"), "first", "last").alias("r")))
    wanted = materialize(shared.select("ord", "d").distinct())
    few = wanted.count() <= BROADCAST_KEYS
    per_text = shared.groupBy("ord", "d").agg(F.collect_list("r").alias("runs"))  # as long as the text at most
    bodies = single.select("ord", "d", "body").join(F.broadcast(wanted) if few else wanted, ["ord", "d"], "left_semi")
    runs = materialize(_runs_with_bytes(bodies.join(per_text, ["ord", "d"]).select("ord", "d", "runs", "body"), length))
    size = runs.agg(F.sum(F.octet_length("bytes")), F.sum(F.octet_length("bytes") - length + 1)).first()[0] or 0
    shards = max(1, int(documents.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-size // SORTED_BYTES))
    salt = F.pmod(F.xxhash64("ord", "d", "first"), F.col("salts")).cast("int")
    dealt = runs.withColumn("salt", salt).repartition(shards, "h", "salt").sortWithinPartitions("h", "salt")
    sorted_ = materialize(_sort_shards(dealt, length))
    here = sorted_.filter("digest is null").select("ord", "d", "first", "last")
    leads = sorted_.filter("digest is not null").select("ord", "d", "first", "digest")
    place = F.struct("ord", "d", "first")
    least = leads.groupBy("digest").agg(F.min(place).alias("p"))
    late = leads.join(least, "digest").filter(place != F.col("p")).select("ord", "d", "first", F.col("first").alias("last"))
    return rows, here.union(late)


def removal(documents: DataFrame, *, id_column: str = "doc_id", text: str = "text", length: int = LENGTH, hot: int = HOT) -> DataFrame:
    """Per row: id, n_bytes, n_removed, n_spans, kept_sha256."""
    rows, windows = covered_windows(documents, id_column=id_column, text=text, length=length, hot=hot)
    per_text = materialize(windows.groupBy("ord", "d").agg(F.sort_array(F.collect_list(F.struct("first", "last"))).alias("runs")))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, "body"):
            removed, spans, sha = [], [], []
            for runs, body in zip(batch.column("runs"), batch.column("body").to_pylist()):
                r = runs.values.flatten()
                a, b = r[0].to_numpy(), r[1].to_numpy() + length
                mark = np.zeros(len(body) + 1, np.int32)
                np.add.at(mark, a, 1)
                np.add.at(mark, b, -1)
                gone = np.cumsum(mark[:-1]) > 0
                removed.append(int(gone.sum()))
                spans.append(int(np.count_nonzero(gone & ~np.append(False, gone[:-1]))))
                sha.append(hashlib.sha256(np.frombuffer(body, np.uint8)[~gone].tobytes()).hexdigest())
            yield pa.RecordBatch.from_arrays([
                batch.column("ord"), batch.column("d"), pa.array(removed, pa.int64()), pa.array(spans, pa.int64()), pa.array(sha, pa.string())],
                names=["ord", "d", "removed", "spans", "kept"])

    few = per_text.count() <= BROADCAST_KEYS
    wanted = per_text.select("ord", "d")
    bodies = _texts(documents, id_column, text).withColumn("d", _key("sha")).select("ord", "d", "body")
    bodies = bodies.join(F.broadcast(wanted) if few else wanted, ["ord", "d"], "left_semi").join(per_text, ["ord", "d"])
    done = bodies.select("ord", "d", "runs", "body").mapInArrow(cut, f"{KEY}, removed bigint, spans bigint, kept string")
    done = materialize(done.dropDuplicates(["ord", "d"]))
    first = F.col("ord") == F.col("origin")
    out = rows.withColumn("d", _key("sha")).join(done, ["ord", "d"], "left")
    # The first row of a text, and its copies, which are covered whole where they hold a window.
    long, nothing = F.col("n") >= length, F.lit(hashlib.sha256(b"").hexdigest())
    own = F.struct(F.coalesce("removed", F.lit(0)).cast("long").alias("n_removed"), F.coalesce("spans", F.lit(0)).cast("long").alias("n_spans"),
                   F.coalesce("kept", "sha").alias("kept_sha256"))
    copy = F.struct(F.when(long, F.col("n")).otherwise(0).cast("long").alias("n_removed"), long.cast("long").alias("n_spans"),
                    F.when(long, nothing).otherwise(F.col("sha")).alias("kept_sha256"))
    kind = documents.schema[id_column].dataType
    identity = F.when(F.col("ord") != -(1 << 63), F.col("ord")).cast(kind)
    some = out.select(identity.alias(id_column), F.col("n").alias("n_bytes"), F.when(first, own).otherwise(copy).alias("r"), copy.alias("c"), "m")
    ones = some.select(id_column, "n_bytes", "r.*")
    more = some.filter("m > 1").select(id_column, "n_bytes", "c.*", F.explode(F.sequence(F.lit(2).cast("long"), F.col("m"))).alias("_")).drop("_")
    return ones.union(more)
