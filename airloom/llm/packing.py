"""Token sequences of bounded length, packed by linear grouping and best fit.

1. Texts become token ids, each document ends with ``end_id``, and only documents longer than a
   sequence are cut, into full pieces; the first piece takes the remainder.
2. The histogram of piece lengths (at most ``capacity`` rows) is all that the driver sees. Large
   lengths are ranked from long to short, cut into groups of equal cardinality and rounded up to
   the longest of their group. The few sizes that are left give a linear programme over
   configurations (multisets of sizes that fit a sequence), solved by column generation.
3. Configurations, used a whole number of times, are filled with actual pieces. As ranks map to
   lengths through the histogram, the space that stays free in every sequence is known, too.
   What rounding down has left over, then the small lengths, go by best fit (long ones first) into
   the tightest sequences, and into new ones at the end.
4. The plan is a bounded list of segments (length, ranks from, to, first sequence, pieces per
   sequence). Ranks within a length are computed by Spark, so that every piece finds its sequence
   by arithmetic and no group of pieces, however hot, meets in one task.

Defined cases: a null text is empty, so it is one piece of one token. Repeated rows are packed one
by one. An empty table gives no pieces. Special tokens written out in a text are ordinary text.
"""

from __future__ import annotations

import base64
import os
import re
import zlib
from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from airloom.llm.common import bounded_batches, chunks, free_name, text_of
from airloom.session import materialize

CAPACITY = 1024
END_ID = 2
#: Lengths up to this share of a sequence are small.
SMALL = 1 / 4
#: Groups of equal cardinality among the large lengths.
GROUPS = 256
#: Pieces that are ranked in one task, about.
RANKED_ROWS = 200_000

#: Texts of these characters alone are split alike by both tokenizer libraries; others go to the
#: slower one, which defines the ids.
_COMMON = re.compile("[^\t\n\r\x20-\x7e -ſ‐-‧]")


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


@lru_cache(maxsize=2)
def _encoder(path: str):
    """text -> ids. The rank file beside the tokenizer, where there is one, is used for speed."""
    from tokenizers import Tokenizer

    slow = Tokenizer.from_file(path)
    slow.encode_special_tokens = True

    def plain(text: str) -> np.ndarray:
        return np.array(slow.encode(text, add_special_tokens=False).ids, np.uint32)

    ranks = os.path.splitext(path)[0] + ".tiktoken"
    if not os.path.exists(ranks):
        return plain
    import public_tokenizers
    import tiktoken

    with open(ranks, "rb") as lines:
        merges = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    fast = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=merges, special_tokens={})

    def quick(text: str) -> np.ndarray:
        return plain(text) if _COMMON.search(text) else fast.encode_to_numpy(text, disallowed_special=()).astype(np.uint32)

    return quick


PIECE = {"piece": "int", "start": "bigint", "length": "bigint", "ids_crc32": "bigint"}


def pieces(
    df: DataFrame, *, id_column: str = "doc_id", text: str = "text", tokenizer: str | None = None,
    capacity: int = CAPACITY, end_id: int = END_ID, with_ids: bool = False,
) -> DataFrame:
    """One row per piece: the id, piece, start, length, ids_crc32, and ``ids`` on request."""
    path = tokenizer or default_tokenizer()
    t = free_name(df, "_text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = _encoder(path)
        for batch in chunks(batches, t):
            rows: dict[str, list] = {k: [] for k in ("row", *PIECE, "ids")}
            for i, s in enumerate(batch.column(t).to_pylist()):
                ids = np.append(encode(s), np.uint32(end_id)).astype("<u4")
                first = len(ids) % capacity or min(capacity, len(ids))
                for n, b in enumerate(range(first, len(ids) + 1, capacity)):
                    a = max(0, b - capacity) if n else 0
                    part = ids[a:b]
                    rows["row"].append(i)
                    rows["piece"].append(n)
                    rows["start"].append(a)
                    rows["length"].append(b - a)
                    rows["ids_crc32"].append(zlib.crc32(part.tobytes()))
                    if with_ids:
                        rows["ids"].append(part)
            out = {
                id_column: batch.column(id_column).take(pa.array(rows["row"], pa.int64())),
                "piece": pa.array(rows["piece"], pa.int32()),
                **{k: pa.array(rows[k], pa.int64()) for k in ("start", "length", "ids_crc32")},
            }
            if with_ids:
                out["ids"] = pa.array(rows["ids"], pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays(list(out.values()), names=list(out))

    bounded_batches(df.sparkSession)
    fields = [f"`{id_column}` {df.schema[id_column].dataType.simpleString()}", *(f"{k} {v}" for k, v in PIECE.items())]
    fed = df.select(id_column, text_of(text).alias(t))
    return fed.mapInArrow(run, ", ".join(fields + ["ids array<int>"] * with_ids))


# --- the plan, from the histogram alone ------------------------------------------------

def configurations(sizes: np.ndarray, demand: np.ndarray, capacity: int) -> list[tuple[np.ndarray, float]]:
    """(how many of each size, times used) of the linear programme's optimum, by column generation.

    Every size is at most ``capacity``. The programme has one row per size, so at most as many
    configurations are used; pricing is an unbounded knapsack over the capacity.
    """
    k = len(sizes)
    columns = np.diag(np.maximum(1, capacity // sizes).astype(float))
    inverse = np.diag(1 / np.diag(columns))
    used = inverse @ demand
    most = capacity // int(sizes.min())
    room = np.arange(capacity + 1)[None, :] - sizes[:, None]
    fits = room >= 0
    room = np.maximum(room, 0)
    for _ in range(40 * k):
        value = inverse.sum(axis=0)  # dual values: every configuration costs one sequence
        best, ways = np.zeros(capacity + 1), []
        for _ in range(most):  # by number of pieces; a piece may stay out
            gain = np.where(fits, best[room] + value[:, None], 0)
            way = gain.argmax(axis=0)
            best = gain[way, np.arange(capacity + 1)]
            ways.append(way)
        if best[capacity] <= 1 + 1e-7:
            break
        new, c = np.zeros(k), capacity
        for way in reversed(ways):
            i = int(way[c])
            if fits[i, c] and value[i] > 0:
                new[i] += 1
                c -= int(sizes[i])
        step = inverse @ new
        ratio = np.where(step > 1e-9, used / np.where(step > 1e-9, step, 1), np.inf)
        out = int(ratio.argmin())
        columns[:, out] = new
        pivot = inverse[out] / step[out]
        inverse -= np.outer(step, pivot)
        inverse[out] = pivot
        used = np.maximum(inverse @ demand, 0)
    return [(columns[:, j].astype(np.int64), float(used[j])) for j in range(k) if used[j] > 1e-9]


class _Plan:
    def __init__(self, histogram: dict[int, int], capacity: int):
        self.capacity = capacity
        self.count = histogram
        self.taken = dict.fromkeys(histogram, 0)  # pieces of a length that have a place
        self.segments: list[tuple[int, int, int, int, int, int]] = []
        self.bins = 0
        self.free: dict[int, list[tuple[int, int]]] = defaultdict(list)  # space -> ranges of sequences

    def place(self, length: int, n: int, first_bin: int, per_bin: int, phase: int = 0) -> None:
        """The next ``n`` pieces of a length, ``per_bin`` a sequence, the first one holding ``phase`` already."""
        at = self.taken[length]
        self.segments.append((length, at, at + n, first_bin, per_bin, phase))
        self.taken[length] = at + n

    def best_fit(self, length: int) -> None:
        """The rest of the pieces of ``length`` into the tightest sequences, then into new ones."""
        rest = self.count[length] - self.taken[length]
        for space in sorted(s for s in self.free if s >= length):
            ranges, self.free[space] = self.free[space], []
            per = space // length
            for a, b in ranges:
                full = min(b - a, rest // per)
                if full:
                    self.place(length, full * per, a, per)
                    rest -= full * per
                    self.free[space - per * length].append((a, a + full))
                    a += full
                if a < b and 0 < rest < per:
                    self.place(length, rest, a, per)
                    self.free[space - rest * length].append((a, a + 1))
                    rest, a = 0, a + 1
                if a < b:
                    self.free[space].append((a, b))
            if not rest:
                return
        if rest:
            per = self.capacity // length
            new = -(-rest // per)
            self.free[self.capacity].append((self.bins, self.bins + new))
            self.bins += new
            self.best_fit(length)

    def large(self, lengths: list[int], groups: int) -> None:
        """Linear grouping of the large lengths, given from long to short."""
        order = np.array(lengths)
        counts = np.array([self.count[x] for x in lengths])
        ends = np.cumsum(counts)
        total = int(ends[-1])
        edges = np.unique(np.linspace(0, total, min(groups, total) + 1).round().astype(np.int64))

        def length_at(p: int) -> tuple[int, int]:
            """The length of the piece at place ``p``, and the place where that length ends."""
            i = int(np.searchsorted(ends, p, "right"))
            return int(order[i]), int(ends[i])

        # Groups with one size are one row of the programme.
        sizes, start, stop = [], [], []
        for a, b in zip(edges[:-1].tolist(), edges[1:].tolist()):
            size = length_at(a)[0]
            if sizes and sizes[-1] == size:
                stop[-1] = b
            else:
                sizes.append(size)
                start.append(a)
                stop.append(b)
        demand = np.array(stop, float) - start
        cursor = list(start)
        placed: list[tuple[int, int, int, int, int, int]] = []  # place from, to, length, bin, per, phase
        for config, times in configurations(np.array(sizes), demand, self.capacity):
            whole = int(times + 1e-6)
            for g in np.flatnonzero(config).tolist():
                whole = min(whole, (stop[g] - cursor[g]) // int(config[g]))
            if whole <= 0:
                continue
            # Sequences [0, whole) of this configuration, cut wherever a slot's length changes.
            cuts = {0, whole}
            parts = []
            for g in np.flatnonzero(config).tolist():
                per, p, end = int(config[g]), cursor[g], cursor[g] + int(config[g]) * whole
                while p < end:
                    length, until = length_at(p)
                    until = min(until, end)
                    parts.append((p, until, length, (p - cursor[g]) // per, per, (p - cursor[g]) % per))
                    cuts |= {(p - cursor[g]) // per, -(-(p - cursor[g]) // per), (until - cursor[g]) // per, -(-(until - cursor[g]) // per)}
                    p = until
                cursor[g] = end
            marks = sorted(cuts)
            spare = {m: self.capacity for m in marks[:-1]}
            for p, until, length, first, per, phase in parts:
                placed.append((p, until, length, self.bins + first, per, phase))
                n = until - p
                # Between two marks a part fills each sequence alike.
                for m in marks[:-1]:
                    lo, hi = m * per - first * per - phase, (m + 1) * per - first * per - phase
                    here = min(hi, n) - max(lo, 0)
                    if here > 0:
                        spare[m] -= here * length
            for m, nxt in zip(marks[:-1], marks[1:]):
                self.free[spare[m]].append((self.bins + m, self.bins + nxt))
            self.bins += whole
        # Places become ranks within a length: those of configurations first.
        for p, until, length, first, per, phase in sorted(placed):
            self.place(length, until - p, first, per, phase)
        for length in lengths:
            self.best_fit(length)


def plan(histogram: dict[int, int], *, capacity: int = CAPACITY, small: float = SMALL, groups: int = GROUPS):
    """(segments, number of sequences). A segment: length, ranks from and to, first sequence, pieces
    per sequence, pieces of that segment's kind that its first sequence holds already."""
    p = _Plan(dict(histogram), capacity)
    if full := p.count.get(capacity):
        p.place(capacity, full, 0, 1)
        p.bins = full
    lengths = sorted((x for x in histogram if x < capacity), reverse=True)
    big = [x for x in lengths if x > small * capacity]
    if big:
        p.large(big, groups)
    for length in lengths[len(big):]:
        p.best_fit(length)
    return p.segments, p.bins


def pack(
    pieces: DataFrame, *, length: str = "length", capacity: int = CAPACITY, small: float = SMALL,
    groups: int = GROUPS, ranked_rows: int = RANKED_ROWS,
) -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset`` added. They are stored first, with a row number."""
    uid, bucket, rank = (free_name(pieces, c) for c in ("_uid", "_bucket", "_rank"))
    stored = materialize(pieces.withColumn(uid, F.monotonically_increasing_id()))
    histogram = {r[0]: r[1] for r in stored.groupBy(length).count().collect()}  # at most `capacity` rows
    segments, _ = plan(histogram, capacity=capacity, small=small, groups=groups)
    # Ranks within a length: buckets of bounded size are ranked alone and start where the ones before end.
    buckets = max(1, -(-sum(histogram.values()) // ranked_rows))
    rows = stored.withColumn(bucket, F.pmod(F.xxhash64(uid), F.lit(buckets)))
    sizes = rows.groupBy(length, bucket).count()
    before = Window.partitionBy(length).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(length, bucket, F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_start"))
    inside = F.row_number().over(Window.partitionBy(length, bucket).orderBy(uid)) - 1
    rows = rows.withColumn(rank, inside).join(starts, [length, bucket]).withColumn(rank, F.col(rank) + F.col("_start"))
    names = ("_length", "_from", "_to", "_bin", "_per", "_phase")
    spark = pieces.sparkSession
    table = spark.createDataFrame(pa.table({
        n: pa.array([s[i] for s in segments], pa.int64()) for i, n in enumerate(names)}))
    # At most some thousand rows, whatever the input: lengths times spaces bound them.
    on = (F.col(length) == F.col("_length")) & (F.col(rank) >= F.col("_from")) & (F.col(rank) < F.col("_to"))
    sequence = F.col("_bin") + F.expr(f"(`{rank}` - _from + _phase) DIV _per")
    rows = rows.join(F.broadcast(table), on).withColumn("sequence_id", sequence)
    earlier = Window.partitionBy("sequence_id").orderBy(F.desc(length), uid).rowsBetween(Window.unboundedPreceding, -1)
    offset = F.coalesce(F.sum(length).over(earlier), F.lit(0)).cast("long")
    return rows.withColumn("offset", offset).select(*pieces.columns, "sequence_id", "offset")
