"""The trie of shared conversation beginnings, without ever holding a conversation.

A conversation may take its first turns from another one (``base``, ``head``); every distinct sequence of
first turns is a node.

1. Turns are hashed, and rows range-partitioned by (conversation, turn). A scan numbers them and gives each the
   polynomial hash (two moduli of 61 bits) of all turns up to it. Such hashes add up across tasks, so only the
   totals of conversations that lie in several tasks, two per task at most, are summed up for offsets.
2. Hashes of rebuilt conversations follow by arithmetic from those of their own turns and of the base's first ones.
   Conversations of equal hash and length collapse into one weighted sequence with a list of ends.
3. One representative per sequence spells out its prefixes. Grouping them gives the nodes; sequences that are the
   parent of some node are proper prefixes, and an anti-join drops them, which leaves the leaves.
4. Sums over subtrees need no recursion. A node's smallest member owns the node, and what a sequence owns is the end of
   it. So a sum over distinct nodes below a node is, over the sequences through it, the lesser of what the sequence
   owns and of what it has left from there; a sum over members is a weighted sum of what is left.
5. Ids of one end list are range-partitioned, joined in order to texts of up to ``ENDS`` ids, and hashed as a stream.

A hot turn is a hot group, which is summed before the shuffle; a hot conversation is cut by its tasks, and joined by
broadcast, as there are no more of those than tasks; children of a hot parent are joined by broadcast, too, as fewer
than ``HEAVY`` parents can have more than that part of all nodes. Two different sequences of n turns fall together
with a probability of about (n / 2^61)^2.

Defined cases: null roles and texts are empty. Turns without a number come first; turns with the same number are ordered by
a hash of role and text. Rows without a conversation id belong to no conversation. A conversation without turns, as
rebuilt, is a member of the root alone. An empty table has no nodes. Long texts are hashed where they are read and never
moved. Further columns do not matter.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import groupby

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from airloom.llm.common import bounded_batches
from airloom.session import materialize

PRIME = 2**61 - 1
BASES = (1_304_969_544_928_657_043, 817_263_549_102_736_481)
#: Longest head that is taken from another conversation.
HEAD_MOST = 8
#: Ids of an end list that are joined into one text.
ENDS = 4096
#: Parents that are joined by broadcast have more than this part of all nodes as children.
HEAVY = 1000

_KEY = ["depth", "key1", "key2"]


def _product(a: Column, b: Column) -> Column:
    """a * b modulo PRIME, by way of 38 digits."""
    wide = "decimal(19,0)"
    return (a.cast(wide) * b.cast(wide) % F.lit(PRIME).cast(wide)).cast("bigint")


def _sum(a: Column, b: Column) -> Column:
    return (a + b) % F.lit(PRIME)


def _difference(a: Column, b: Column) -> Column:
    return (a - b + F.lit(PRIME)) % F.lit(PRIME)


# --- numbered turns ---------------------------------------------------------------------

def _numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Place, bytes so far and hashes before and up to every row, from the start of its conversation in this task."""
    part, at = TaskContext.get().partitionId(), None
    i = total = p1 = p2 = 0
    w1 = w2 = 1
    for batch in batches:
        columns: list[list] = [[] for _ in range(6)]
        for conv, digest, size in zip(*(batch.column(c).to_pylist() for c in ("conv", "digest", "bytes"))):
            if conv != at:
                at, i, total, p1, p2, w1, w2 = conv, 0, 0, 0, 0, 1, 1
            i, total = i + 1, total + size
            before = p1, p2
            p1 = (p1 + (1 + int.from_bytes(digest[:8])) % PRIME * w1) % PRIME
            p2 = (p2 + (1 + int.from_bytes(digest[8:16])) % PRIME * w2) % PRIME
            w1, w2 = w1 * BASES[0] % PRIME, w2 * BASES[1] % PRIME
            for values, v in zip(columns, (i, total, *before, p1, p2)):
                values.append(v)
        yield pa.RecordBatch.from_arrays(
            [batch.column("conv"), batch.column("bytes"), pa.array([part] * batch.num_rows, pa.int32()),
             *(pa.array(c, pa.int64()) for c in columns)],
            names=["conv", "bytes", "part", "i", "so_far", "q1", "q2", "p1", "p2"])


def _offsets(key, pieces):
    """What lies before each piece of one conversation; it has a piece per task."""
    rows, n, total, p1, p2 = [], 0, 0, 0, 0
    for r in sorted(pieces.to_pylist(), key=lambda r: r["part"]):
        w1, w2 = (pow(b, n, PRIME) for b in BASES)
        rows.append({"conv": r["conv"], "part": r["part"], "n0": n, "total0": total, "o1": p1, "o2": p2, "w1": w1, "w2": w2})
        n, total = n + r["n"], total + r["total"]
        p1, p2 = (p1 + w1 * r["p1"]) % PRIME, (p2 + w2 * r["p2"]) % PRIME
    return pa.Table.from_pylist(rows, schema=pa.schema([("conv", pa.int64()), ("part", pa.int32())] + [
        (c, pa.int64()) for c in ("n0", "total0", "o1", "o2", "w1", "w2")]))


def _turns(df: DataFrame, id_column: str, turn: str, role: str, text: str) -> tuple[DataFrame, DataFrame]:
    """All turns, numbered, and the conversations (at most one per task) that lie in several tasks."""
    said, name = F.coalesce(F.col(text), F.lit("")), F.coalesce(F.col(role), F.lit(""))
    rows = df.filter(F.col(id_column).isNotNull()).select(
        F.col(id_column).cast("bigint").alias("conv"), F.col(turn).alias("turn"),
        F.unhex(F.sha2(F.concat(F.octet_length(name).cast("string"), F.lit(":"), name, said).cast("binary"), 256)).alias("digest"),
        F.octet_length(said).cast("bigint").alias("bytes"), F.rand(19).alias("salt"))
    order = ["conv", "turn", "digest", "salt"]
    bounded_batches(df.sparkSession, rows=10_000)
    local = materialize(rows.repartitionByRange(*order).sortWithinPartitions(*order).select("conv", "digest", "bytes").mapInArrow(
        _numbered, "conv bigint, bytes bigint, part int, i bigint, so_far bigint, q1 bigint, q2 bigint, p1 bigint, p2 bigint"))
    cut = materialize(local.groupBy("conv").agg(F.min("part").alias("a"), F.max("part").alias("b")).filter("a < b").select("conv"))
    pieces = local.join(F.broadcast(cut), "conv").groupBy("conv", "part").agg(
        F.max("i").alias("n"), F.max("so_far").alias("total"), F.max_by("p1", "i").alias("p1"), F.max_by("p2", "i").alias("p2"))
    before = materialize(pieces.groupBy("conv").applyInArrow(
        _offsets, "conv bigint, part int, n0 bigint, total0 bigint, o1 bigint, o2 bigint, w1 bigint, w2 bigint"))
    moved = local.join(F.broadcast(before), ["conv", "part"]).select(
        "conv", "bytes", (F.col("i") + F.col("n0")).alias("i"), (F.col("so_far") + F.col("total0")).alias("so_far"),
        *[_sum(F.col(f"o{k}"), _product(F.col(f"w{k}"), F.col(f"{c}{k}"))).alias(f"{c}{k}") for c in "qp" for k in (1, 2)],
        F.lit(True).alias("cut"))
    stay = local.join(F.broadcast(cut), "conv", "left_anti").select(*[c for c in moved.columns if c != "cut"], F.lit(False).alias("cut"))
    return stay.unionByName(moved), cut


# --- rebuilt conversations ----------------------------------------------------------------

def _conversations(turns: DataFrame, base: Column, head: Column) -> DataFrame:
    """Per conversation: the head it takes (``first``: its rows in the base), how its own hashes move, its full key."""
    row = F.struct("i", "so_far", "bytes", "q1", "q2", "p1", "p2")
    own = turns.groupBy("conv").agg(
        F.max("i").alias("n"), F.max("so_far").alias("total"), F.max_by("p1", "i").alias("e1"), F.max_by("p2", "i").alias("e2"),
        F.max("cut").alias("cut"), F.sort_array(F.collect_list(F.when(F.col("i") <= HEAD_MOST, row))).alias("first"))
    own = materialize(own.withColumns({"base": base, "head": F.least(head, F.lit(HEAD_MOST)).cast("int")}))
    given = own.select(F.col("conv").alias("base"), F.col("first").alias("theirs"))
    joined = own.join(given, "base", "left")
    taken = F.when(F.col("theirs").isNull(), F.lit(0)).otherwise(F.least("head", F.size("theirs")))
    joined = joined.withColumn("taken", taken).withColumns({
        "theirs": F.slice(F.coalesce("theirs", F.expr("filter(first, x -> false)")), F.lit(1), F.col("taken")),
        "tail": F.col("n") > F.col("head"),
        "left_out": F.when((F.col("head") > 0) & (F.col("n") > F.col("head")), F.col("first")[F.col("head") - 1])})
    # A turn moves from place i to i - head + taken, which is a factor of the base's power.
    moves = {}
    for k in (1, 2):
        powers = F.array(*[F.lit(pow(BASES[k - 1], -n, PRIME)).cast("bigint") for n in range(HEAD_MOST + 1)])
        moves[f"f{k}"] = powers[F.col("head") - F.col("taken")]
    joined = joined.withColumns(moves)
    kept = {}
    for k in (1, 2):
        theirs = F.coalesce(F.when(F.col("taken") > 0, F.col("theirs")[F.col("taken") - 1][f"p{k}"]), F.lit(0).cast("bigint"))
        mine = F.coalesce(F.col("left_out")[f"p{k}"], F.lit(0).cast("bigint"))
        kept[f"a{k}"] = _difference(theirs, _product(mine, F.col(f"f{k}")))
        kept[f"h{k}"] = theirs
    before = F.coalesce(F.when(F.col("taken") > 0, F.col("theirs")[F.col("taken") - 1]["so_far"]), F.lit(0).cast("bigint"))
    mine = F.when(F.col("tail"), F.col("total") - F.coalesce(F.col("left_out")["so_far"], F.lit(0).cast("bigint"))).otherwise(F.lit(0).cast("bigint"))
    joined = joined.withColumns(kept).withColumn("bytes", before + mine)
    full = {f"key{k}": F.when(F.col("tail"), _sum(F.col(f"a{k}"), _product(F.col(f"e{k}"), F.col(f"f{k}")))).otherwise(F.col(f"h{k}")) for k in (1, 2)}
    length = F.col("taken") + F.when(F.col("tail"), F.col("n") - F.col("head")).otherwise(F.lit(0))
    return joined.select("conv", "base", "head", "taken", "tail", "cut", "total", "theirs", "bytes", "f1", "f2", "a1", "a2",
                         length.cast("bigint").alias("depth"), *[c.alias(n) for n, c in full.items()])


def _joined(rows: DataFrame, table: DataFrame, key: str) -> DataFrame:
    """Inner join on a conversation; those cut by tasks, no more than tasks, go by broadcast."""
    whole = rows.filter("not cut").drop("cut").join(table.filter("not cut").drop("cut"), key)
    cut = rows.filter("cut").drop("cut").join(F.broadcast(table.filter("cut").drop("cut")), key)
    return whole.withColumn("cut", F.lit(False)).unionByName(cut.withColumn("cut", F.lit(True)))


def _prefixes(turns: DataFrame, chosen: DataFrame) -> DataFrame:
    """All prefixes of the representatives: key, parent key, bytes of the last text, bytes from there to the end,
    and the turn they end with."""
    heads = chosen.select(
        "conv", "weight", "cut", "base", F.col("bytes").alias("left"), F.explode(F.concat(
            F.array(F.struct(*[F.lit(0).cast("bigint").alias(c) for c in ("i", "so_far", "bytes", "q1", "q2", "p1", "p2")])), "theirs")).alias("t"))
    heads = heads.select(
        "conv", "weight", "cut", F.col("t.i").alias("depth"), F.col("t.p1").alias("key1"), F.col("t.p2").alias("key2"),
        F.col("t.q1").alias("up1"), F.col("t.q2").alias("up2"), F.col("t.bytes").alias("bytes"),
        (F.col("left") - F.col("t.so_far") + F.col("t.bytes")).alias("left"),
        F.when(F.col("t.i") > 0, F.col("base")).alias("source_conv"), F.when(F.col("t.i") > 0, F.col("t.i")).alias("source_place"))
    moved = chosen.filter("tail").select("conv", "weight", "cut", "head", "taken", "total", "f1", "f2", "a1", "a2")
    tails = _joined(turns, moved, "conv").filter("i > head")

    def at(c: str, k: int) -> Column:
        place = F.col(f"{c}{k}")
        return _sum(F.col(f"a{k}"), F.when(F.col("head") == F.col("taken"), place).otherwise(_product(place, F.col(f"f{k}"))))

    tails = tails.select(
        "conv", "weight", "cut", (F.col("i") - F.col("head") + F.col("taken")).alias("depth"), at("p", 1).alias("key1"), at("p", 2).alias("key2"),
        at("q", 1).alias("up1"), at("q", 2).alias("up2"), "bytes", (F.col("total") - F.col("so_far") + F.col("bytes")).alias("left"),
        F.col("conv").alias("source_conv"), F.col("i").alias("source_place"))
    return heads.unionByName(tails)


def _end_lists(members: DataFrame) -> DataFrame:
    """Per sequence the hash of its members' ids, in order and joined by commas."""
    order = [*_KEY, "conv"]
    schema = "depth bigint, key1 bigint, key2 bigint, first bigint, ids string"

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, ids = None, []

        def row():
            return pa.RecordBatch.from_arrays([pa.array([v], pa.int64()) for v in (*key, ids[0])] + [pa.array([",".join(map(str, ids))])],
                                              names=[*_KEY, "first", "ids"])

        for batch in batches:
            for *at, conv in zip(*(batch.column(c).to_pylist() for c in order)):
                if at != key or len(ids) == ENDS:
                    if ids:
                        yield row()
                    key, ids = at, []
                ids.append(conv)
        if ids:
            yield row()

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (r for batch in batches for r in zip(*(batch.column(c).to_pylist() for c in [*_KEY, "ids"])))
        out: list[tuple] = []
        for key, texts in groupby(rows, key=lambda r: r[:3]):
            found = hashlib.sha256()
            for n, (*_, ids) in enumerate(texts):
                found.update(("," if n else "").encode() + ids.encode())
            out.append((*key, found.hexdigest()))
            if len(out) == 4096:
                yield made(out)
                out = []
        if out:
            yield made(out)

    def made(rows: list[tuple]) -> pa.RecordBatch:
        *keys, ends = zip(*rows)
        return pa.RecordBatch.from_arrays([*(pa.array(k, pa.int64()) for k in keys), pa.array(ends, pa.string())], names=[*_KEY, "ends_sha256"])

    texts = members.select(*order).repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(join, schema)
    return texts.repartition(*_KEY).sortWithinPartitions(*_KEY, "first").mapInArrow(
        hashed, "depth bigint, key1 bigint, key2 bigint, ends_sha256 string")


def trie(
    df: DataFrame, *, id_column: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
    base: Column | None = None, head: Column | None = None,
) -> DataFrame:
    """One row per node: ``conv_id`` (smallest member), ``depth``, ``parent_conv_id``, ``n_convs``, ``n_children``,
    ``n_leaves``, ``saved_tokens``, ``ends_sha256``, and the turn that it ends with as ``source_conv``, ``source_place``
    (from 1, in the order of that conversation's own turns; null at the root).

    ``base`` and ``head`` are expressions over the column ``conv``: the conversation that the first turns are taken from, and
    how many (at most HEAD_MOST). ``saved_tokens`` sums, over a node's subtree, (members - 1) times the UTF-8 bytes of the last text.
    """
    turns, _ = _turns(df, id_column, turn, role, text)
    conversations = materialize(_conversations(
        turns, F.col("conv") if base is None else base, F.lit(0) if head is None else head))
    sequences = materialize(conversations.groupBy(*_KEY).agg(F.count(F.lit(1)).alias("weight"), F.min("conv").alias("conv")))
    chosen = conversations.drop(*_KEY).join(sequences.select("conv", "weight"), "conv")
    prefixes = materialize(_prefixes(turns, chosen))
    nodes = materialize(prefixes.groupBy(*_KEY).agg(
        F.min("conv").alias("conv_id"), F.sum("weight").alias("n_convs"), F.min("up1").alias("up1"), F.min("up2").alias("up2"),
        F.min("bytes").alias("bytes"), F.sum(F.col("weight") * F.col("left")).alias("gross"),
        F.min_by(F.struct("source_conv", "source_place"), "conv").alias("source")))
    children = materialize(nodes.filter("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), F.col("up1").alias("key1"), F.col("up2").alias("key2")).agg(
        F.count(F.lit(1)).alias("n_children")))
    # Proper prefixes are parents; the sequences without them are the leaves.
    leaves = sequences.join(children, _KEY, "left_anti").select("conv", F.lit(1).alias("leaf"))
    owned = nodes.groupBy(F.col("conv_id").alias("conv")).agg(F.sum("bytes").alias("owned"))
    facts = conversations.select("conv", "cut").join(sequences.select("conv"), "conv").join(leaves, "conv", "left").join(owned, "conv", "left")
    below = _joined(prefixes.select("conv", "cut", *_KEY, "left"), materialize(facts), "conv").groupBy(*_KEY).agg(
        F.count("leaf").alias("n_leaves"), F.sum(F.least("left", F.coalesce("owned", F.lit(0).cast("bigint")))).alias("once"))
    full = nodes.join(below, _KEY).join(children, _KEY, "left").join(_end_lists(conversations), _KEY, "left")
    # Fewer than HEAVY parents can have more than that part of the nodes below them.
    limit = nodes.count() // HEAVY
    parents = nodes.select(*_KEY, F.col("conv_id").alias("parent_conv_id")).join(children, _KEY)
    parents = materialize(parents.withColumn("heavy", F.col("n_children") > limit).select(
        (F.col("depth") + 1).alias("depth"), F.col("key1").alias("up1"), F.col("key2").alias("up2"), "parent_conv_id", "heavy"))
    up = ["depth", "up1", "up2"]
    hot = full.join(F.broadcast(parents.filter("heavy").drop("heavy")), up, "left")
    mild = hot.filter("parent_conv_id is null").drop("parent_conv_id").join(parents.filter("not heavy").drop("heavy"), up, "left")
    return hot.filter("parent_conv_id is not null").unionByName(mild).select(
        "conv_id", "depth", "parent_conv_id", "n_convs", F.coalesce("n_children", F.lit(0).cast("bigint")).alias("n_children"), "n_leaves",
        (F.col("gross") - F.col("once")).alias("saved_tokens"), F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"),
        "source.source_conv", "source.source_place")
