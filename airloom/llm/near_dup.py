"""Near duplicates by a chosen-path set similarity join.

1. A text's set holds its distinct five-word shingles as 64-bit hashes. Equal sets form a class
   (its key is a 128-bit digest of the set); only one of a class goes on.
2. Every class has ``COORDINATES`` minwise tokens. Independent trees branch on them: a node picks
   some coordinates by a hash of its path, and a set goes to the child named by each picked
   coordinate and its token there. Two sets of similarity 0.75 meet in one child on average, so
   that branches of similar sets live on and others die out.
3. In each node all sets are compared with two of its sets, one of them that with the smallest id
   (an original, often). Sets that confirmed links have joined in one component need no further
   comparison, so a large group of near copies takes a few comparisons each. Of nodes with few open
   pairs (``OPEN`` for each of their sets, as a node of 16 unrelated sets has) all open pairs are
   compared: sets outside the node's largest component, of which there are ``4 * OPEN`` at most, with
   all of its sets. Other nodes branch again, by size, too, as similar sets have similar sizes.
4. Then the first level's nodes that had many open pairs are looked at again, and the sets of those
   that still have (texts around a common passage or a large group that they nearly resemble) are
   joined exactly: two similar sets share one of the rarest quarter of their shingles, and sets of
   different components that do are compared.
5. Links are confirmed on the full sets: 100 * intersection >= 75 * union.

A pair at the threshold shares 12 of the 16 first-level nodes on average, and none with probability
2e-10. In one that it shares it is compared or joined exactly, so no link depends on deeper luck. Pairs of
compared nodes are estimated first, which passes over a pair at the threshold with probability 2e-9;
those of the exact join are not.

Defined cases: a null or empty text, or one without words, has the empty set and links with
nothing. Repeated rows are members of one class. Rows with a null id are never linked, and are
kept. Texts of any length are compared by their whole sets. An empty table gives no rows. Only
id and text are read, so other columns and their names never matter.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from airloom.llm.common import bounded_batches, chunks, text_of
from airloom.llm.components import components
from airloom.session import materialize

WORDS = 5
COORDINATES = 64
TREES = 16
#: Coordinates that the root of a tree branches on.
ROOT = 1
OPEN = 8
DEPTH = 2
SIMILAR = 75
#: Pairs of a node whose estimate is below this are not confirmed: at a similarity of 0.75 the
#: estimate from 64 coordinates falls short of it with a probability of 2e-9.
ESTIMATE = 0.375
#: Ids of texts to fetch are broadcast up to this number (8 bytes each), else joined by a shuffle.
BROADCAST_IDS = 4_000_000

_U = np.uint64


def mix(x: np.ndarray) -> np.ndarray:
    """A well mixed 64-bit hash of 64-bit numbers."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
        return x ^ (x >> _U(31))


_SEEDS = mix(np.arange(1, 4 * COORDINATES + 1, dtype=np.uint64) * _U(0x9E3779B97F4A7C15))
_ODD = _SEEDS[:COORDINATES] | _U(1)
_PLUS = _SEEDS[COORDINATES: 2 * COORDINATES]


class _Words(dict):
    """Hashes of words, remembered; it starts anew when it grows large."""

    def __missing__(self, word: bytes) -> int:
        import xxhash

        if len(self) > 100_000:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


def shingles(text: bytes, words: _Words, n: int = WORDS) -> np.ndarray:
    """Sorted distinct hashes of the ``n``-word shingles; the whole text is one if it is shorter.

    ``bytes`` lower-case ASCII letters only and split at ASCII white space only, as is wanted.
    """
    parts = text.lower().split()
    if not parts:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(words.__getitem__, parts), np.uint64, len(parts))
    width = min(n, len(h))
    out = np.full(len(h) - width + 1, _U(width))
    with np.errstate(over="ignore"):
        for i in range(width):
            out = mix(out * _U(0x9E3779B97F4A7C15) + h[i: len(h) - width + 1 + i])
    return np.unique(out)


def signature(s: np.ndarray) -> np.ndarray:
    """The minwise token of every coordinate, as 32 bits."""
    low = np.full(COORDINATES, np.iinfo(np.uint64).max, np.uint64)
    with np.errstate(over="ignore"):
        for i in range(0, len(s), 4096):
            part = s[None, i:i + 4096] * _ODD[:, None] + _PLUS[:, None]
            low = np.minimum(low, (part ^ (part >> _U(29))).min(axis=1))
    return (low * _U(0x9E3779B97F4A7C15) >> _U(32)).astype(np.uint32)


def key_of(s: np.ndarray) -> bytes:
    """128-bit digest of a set."""
    import xxhash

    return xxhash.xxh3_128_digest(s.tobytes())


def sketches(documents: DataFrame, id_column: str, text: str) -> DataFrame:
    """(id, n, k, sig) per row; an empty set has null k and sig."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = _Words()
        for batch in chunks(batches, "text"):
            sets = [shingles(t, words) for t in batch.column("text").cast(pa.binary()).to_pylist()]
            yield pa.RecordBatch.from_arrays([
                batch.column("id"), pa.array([len(s) for s in sets], pa.int64()),
                pa.array([key_of(s) if len(s) else None for s in sets], pa.binary()),
                pa.array([signature(s).tobytes() if len(s) else None for s in sets], pa.binary()),
            ], names=["id", "n", "k", "sig"])

    bounded_batches(documents.sparkSession)
    rows = documents.select(F.col(id_column).cast("bigint").alias("id"), text_of(text).alias("text"))
    return rows.mapInArrow(run, "id bigint, n bigint, k binary, sig binary")


def _signatures(batch: pa.RecordBatch) -> np.ndarray:
    return np.frombuffer(b"".join(batch.column("sig").to_pylist()), np.uint32).reshape(-1, COORDINATES)


MEMBER = "node bigint, k binary, id bigint, n bigint"


def _members(node: np.ndarray, batch: pa.RecordBatch, row: np.ndarray) -> pa.RecordBatch:
    row = pa.array(row)
    return pa.RecordBatch.from_arrays(
        [pa.array(node.view(np.int64)), *(batch.column(c).take(row) for c in ("k", "id", "n"))], names=["node", "k", "id", "n"])


def roots(classes: DataFrame, trees: int = TREES) -> DataFrame:
    """(node, k, id, n): every class in the first level of all trees."""
    picked = np.argsort(mix(_SEEDS[2 * COORDINATES: 3 * COORDINATES]))
    coordinate = np.array([picked[(t * ROOT + j) % COORDINATES] for t in range(trees) for j in range(ROOT)])
    path = np.array([t * COORDINATES + c + 1 for t, c in zip(np.repeat(np.arange(trees), ROOT), coordinate)], np.uint64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            node = mix(mix(path)[None, :] ^ _signatures(batch)[:, coordinate].astype(np.uint64))
            row = np.repeat(np.arange(batch.num_rows), len(coordinate))
            yield _members(node.ravel(), batch, row)

    return classes.select("k", "id", "n", "sig").mapInArrow(run, MEMBER)


def branch(rows: DataFrame, by_size: bool) -> DataFrame:
    """(node, k, id, n, sig) -> (node, k, id, n) one level down. A coordinate is picked with
    probability 1 / (0.75 * COORDINATES), by a hash of the node, so for all sets of the node alike.

    With ``by_size`` a child is cut into overlapping classes of size: a set goes to its own class
    and to the next, and classes are so wide that similar sets share one.
    """
    limit = _U(int(2**64 / (SIMILAR / 100 * COORDINATES)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            node = batch.column("node").to_numpy().view(np.uint64)
            names = mix(node[:, None] ^ _SEEDS[None, 3 * COORDINATES:])
            row, coordinate = np.nonzero(mix(names) < limit)
            child = mix(names[row, coordinate] ^ _signatures(batch)[row, coordinate].astype(np.uint64))
            if by_size:
                size = np.floor(np.log(batch.column("n").to_numpy()[row]) / np.log(100 / SIMILAR) - 1e-9).astype(np.int64).astype(np.uint64)
                child, row = np.concatenate([mix(child ^ mix(size)), mix(child ^ mix(size + _U(1)))]), np.append(row, row)
            yield _members(child, batch, row)

    return rows.select("node", "k", "id", "n", "sig").mapInArrow(run, MEMBER)


def likely(pairs: DataFrame, classes: DataFrame, least: float = ESTIMATE) -> DataFrame:
    """Pairs (a, b) whose sizes allow the similarity and whose estimate does not rule it out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, y = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint32).reshape(-1, COORDINATES)
                    for c in ("sig_a", "sig_b"))
            keep = (x == y).mean(axis=1) >= least
            yield batch.filter(pa.array(keep)).select(["a", "b"])

    one, two = (classes.select(F.col("k").alias(c), F.col("n").alias(f"n_{c}"), F.col("sig").alias(f"sig_{c}")) for c in "ab")
    sized = pairs.join(one, "a").join(two, "b").filter(
        f"100 * least(n_a, n_b) >= {SIMILAR} * greatest(n_a, n_b)")
    return sized.select("a", "b", "sig_a", "sig_b").mapInArrow(run, "a binary, b binary")


def full_sets(wanted: DataFrame, classes: DataFrame, documents: DataFrame, id_column: str, text: str) -> DataFrame:
    """(k, s), stored: the sorted hashes of the sets of the wanted classes ``k``."""
    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = _Words()
        for batch in chunks(batches, "text"):
            sets = [shingles(t, words) for t in batch.column("text").cast(pa.binary()).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [pa.array([key_of(s) for s in sets], pa.binary()), pa.array([s.tobytes() for s in sets], pa.binary())],
                names=["k", "s"])

    bounded_batches(documents.sparkSession, rows=500)
    ids = materialize(classes.join(wanted.select("k").distinct(), "k").select("id").distinct())
    small = ids.count() <= BROADCAST_IDS
    texts = documents.select(F.col(id_column).cast("bigint").alias("id"), text_of(text).alias("text"))
    texts = texts.join(F.broadcast(ids) if small else ids, "id", "left_semi")
    return materialize(
        texts.select("text").mapInArrow(fetch, "k binary, s binary").groupBy("k").agg(F.first("s").alias("s")))


def sharing_rare(sets: DataFrame, parts: DataFrame) -> DataFrame:
    """Pairs (a, b) of different components whose sets share one of their rarest shingles.

    A set of n shingles has no similar one that shares none of its n - ceil(0.75 n) + 1 rarest, in
    one order for all sets; and what follows the first shared one in both sets must suffice for
    the similarity. ``parts``: (k, c). Shingles of a single set fill the place of rare ones and meet
    nothing, so a set with many own shingles gives few rows or none.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [np.frombuffer(s, np.int64) for s in batch.column("s").to_pylist()]
            row = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
            n = np.array([len(s) for s in sets], np.int64)
            if len(row):
                yield pa.RecordBatch.from_arrays(
                    [batch.column("k").take(pa.array(row)), pa.array(n[row]), pa.array(np.concatenate(sets))], names=["k", "n", "x"])

    rows = sets.mapInArrow(run, "k binary, n bigint, x bigint")
    often = rows.groupBy("x").count().filter("count > 1")
    shared = materialize(rows.join(often, "x"))
    own = F.col("n") - F.count("*").over(Window.partitionBy("k"))
    rank = F.row_number().over(Window.partitionBy("k").orderBy("count", "x"))
    rare = F.col("n") - F.ceil(F.col("n") * SIMILAR / 100) + 1
    first = shared.withColumn("place", own + rank).filter(F.col("place") <= rare)
    first = materialize(first.select("k", "x", "n", (F.col("n") - F.col("place") + 1).alias("left")).join(parts, "k"))
    # Sets outside a shingle's largest component meet all of its sets, so that a large component is
    # not joined with itself.
    counts = first.groupBy("x", "c").agg(F.count("*").alias("m"))
    mixed = counts.groupBy("x").agg(F.max(F.struct("m", "c"))["c"].alias("big"), F.count("*").alias("parts")).filter("parts > 1")
    first = first.join(mixed.select("x", "big"), "x")
    other = first.filter("c <> big").select(
        "x", F.col("k").alias("b"), F.col("c").alias("d"), F.col("n").alias("m"), F.col("left").alias("over"))
    enough = f"{100 + SIMILAR} * least(left, over) >= {SIMILAR} * (n + m)"
    return first.join(other, "x").filter(f"c <> d and (c = big or k < b) and {enough}").select(F.col("k").alias("a"), "b")


def confirm(pairs: DataFrame, classes: DataFrame, documents: DataFrame, id_column: str, text: str) -> DataFrame:
    """The pairs (a, b) that the full sets confirm. ``pairs`` is stored."""
    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("s_a"), batch.column("s_b")):
                x, y = (np.frombuffer(v.as_buffer(), np.uint64) for v in (x, y))
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * both >= SIMILAR * (len(x) + len(y) - both))
            yield batch.filter(pa.array(keep, pa.bool_())).select(["a", "b"])

    wanted = pairs.select(F.col("a").alias("k")).union(pairs.select(F.col("b").alias("k")))
    sets = full_sets(wanted, classes, documents, id_column, text)
    one, two = (sets.select(F.col("k").alias(c), F.col("s").alias(f"s_{c}")) for c in "ab")
    out = pairs.join(one, "a").join(two, "b").select("a", "b", "s_a", "s_b").mapInArrow(check, "a binary, b binary")
    return materialize(out)


def link(
    documents: DataFrame, *, id_column: str = "doc_id", text: str = "text", trees: int = TREES, open_pairs: float = OPEN,
    depth: int = DEPTH,
) -> DataFrame:
    """One row per row of ``documents``: id, n_shingles, component_id (smallest id reachable), kept."""
    spark = documents.sparkSession
    rows = materialize(sketches(documents, id_column, text))
    linked = rows.filter("k is not null and id is not null")
    classes = materialize(linked.groupBy("k").agg(
        F.min("id").alias("id"), F.first("n").alias("n"), F.first("sig").alias("sig")))
    edges = spark.createDataFrame([], "a binary, b binary")
    tried = edges
    root = spark.createDataFrame([], "id binary, root binary")

    def component(members: DataFrame) -> DataFrame:
        """Members with the component ``c`` they are in so far."""
        named = root.select(F.col("id").alias("k"), F.col("root").alias("c"))
        return members.select("node", "k", "id", "n").join(named, "k", "left").select(
            "node", "k", "id", "n", F.coalesce("c", "k").alias("c"))

    def compare(pairs: DataFrame, exact: DataFrame | None = None) -> None:
        """Confirm the pairs that their estimate does not rule out, and all of ``exact``."""
        nonlocal edges, tried, root

        def new(some: DataFrame) -> DataFrame:
            some = materialize(some.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
            return some.join(tried, ["a", "b"], "left_anti")

        pairs = likely(new(pairs), classes)
        pairs = materialize(pairs if exact is None else pairs.union(new(exact)).distinct())
        if pairs.isEmpty():
            return
        found = confirm(pairs, classes, documents, id_column, text)
        tried = tried.union(pairs)
        if not found.isEmpty():
            edges = root.select(F.col("id").alias("a"), F.col("root").alias("b")).union(found)
            root = materialize(components(edges))

    def mixed(members: DataFrame) -> DataFrame:
        """Members of nodes that hold two components at least, with two of the node's sets, its largest
        component and whether it has few open pairs."""
        parts = members.groupBy("node", "c").agg(
            F.count("*").alias("m"), F.min(F.struct("k", "c")).alias("some"), F.min(F.struct("id", "k", "c")).alias("first"))
        sizes = parts.groupBy("node").agg(
            F.sum("m").alias("size"), F.sum(F.col("m") * F.col("m")).alias("same"), F.count("*").alias("parts"),
            F.min("some").alias("some"), F.min("first").alias("first"), F.max(F.struct("m", "c"))["c"].alias("big"))
        few = (F.col("size") * F.col("size") - F.col("same")) / 2 <= open_pairs * F.col("size")
        return members.join(sizes.filter("parts > 1").select("node", "some", "first", "big", few.alias("few")), "node")

    def with_two(nodes: DataFrame) -> DataFrame:
        """Pairs of a node's sets with two of them."""
        two = F.array(F.struct("first.k", "first.c"), F.col("some"))
        met = nodes.select("k", "c", F.explode(F.array_distinct(two)).alias("with")).filter("c <> with.c")
        return met.select(F.col("with.k").alias("a"), F.col("k").alias("b"))

    def within(nodes: DataFrame) -> DataFrame:
        """Open pairs of the nodes that have few.

        With s sets outside the largest component, which has m, the open pairs are s * m at least, and a
        quarter of the squared size where m is less than half of it: so s is 4 * ``open_pairs`` at most.
        """
        few = nodes.filter("few").select("node", "k", "c", "big")
        outside = few.filter("c <> big").groupBy("node").agg(F.collect_list(F.struct(F.col("k").alias("b"), F.col("c").alias("d"))).alias("o"))
        met = few.join(outside, "node").select("k", "c", F.explode("o").alias("o"))
        return met.filter("c <> o.d").select(F.col("k").alias("a"), F.col("o.b").alias("b"))

    nodes = materialize(mixed(component(roots(classes, trees))))
    compare(with_two(nodes))
    nodes = materialize(mixed(component(nodes)))
    crowded = nodes.filter("not few").select("node", "k", "id", "n")
    for level in range(1, depth):
        large = nodes.filter("not few").select("node", "k", "id", "n")
        below = branch(large.join(classes.select("k", "sig"), "k"), by_size=level == 1)
        below = materialize(mixed(component(below)))
        compare(within(nodes).union(with_two(below)))
        nodes = materialize(mixed(component(below)))
    compare(within(nodes))
    # Every node is a part of one of the first level, whose open pairs are all that is left.
    nodes = materialize(mixed(component(crowded)))
    rest = materialize(nodes.filter("not few").groupBy("k").agg(F.min("c").alias("c")))
    compare(within(nodes), None if rest.isEmpty() else sharing_rare(
        full_sets(rest, classes, documents, id_column, text), rest))
    # The smallest id of every component; classes without a link are their own.
    named = classes.select("k", "id").join(root.select(F.col("id").alias("k"), "root"), "k", "left")
    named = named.select("k", "id", F.coalesce("root", "k").alias("root"))
    low = named.groupBy("root").agg(F.min("id").alias("component_id"))
    named = materialize(named.join(low, "root").select("k", "component_id"))
    out = rows.filter("k is not null and id is not null").select("id", "n", "k").join(named, "k").select("id", "n", "component_id")
    alone = rows.filter("k is null or id is null").select("id", "n", F.col("id").alias("component_id"))
    return out.union(alone).select(
        F.col("id").alias(id_column), F.col("n").alias("n_shingles"), "component_id",
        F.coalesce(F.col("id") == F.col("component_id"), F.lit(True)).alias("kept"))


def distinct(documents: DataFrame, *, id_column: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The rows of ``documents`` that stay: one of each component, with the smallest id.

    Of rows that repeat an id one stays, the one with the smallest text; rows with a null id stay.
    """
    found = materialize(link(documents, id_column=id_column, text=text, **options))
    dropped = found.filter(~F.col("kept")).select(id_column).distinct()
    many = dropped.count() > BROADCAST_IDS
    rows = documents.join(dropped if many else F.broadcast(dropped), id_column, "left_anti").select(*documents.columns)
    repeated = materialize(found.filter(F.col(id_column).isNotNull()).groupBy(id_column).count().filter("count > 1").select(id_column))
    if repeated.isEmpty():
        return rows
    once = rows.join(repeated, id_column, "left_anti").select(*documents.columns)
    again = rows.join(repeated, id_column, "left_semi").select(F.struct(*(F.col(c) for c in documents.columns)).alias("r"))
    first = again.groupBy(F.col(f"r.{id_column}").alias("i")).agg(F.min_by("r", F.coalesce(F.col(f"r.{text}"), F.lit(""))).alias("r"))
    return once.union(first.select("r.*"))
