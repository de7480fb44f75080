"""Cheapest repair of damaged conversations into ``s?(user assistant)+`` order, by parallel Viterbi.

Rows of a conversation, by turn, are kept (0), given another role (1) or deleted (2), and rows without text
may be inserted (5); blank rows and repetitions must go, and a truncated row that stays costs 5 more. Four
states (nothing yet, after system, after user, after assistant) make this a shortest path.

1. Rows are range-partitioned by (conversation, turn), so a conversation of any size is cut into pieces, one
   per task, and no key fills a task. Conversations that lie inside a task are solved there.
2. Pieces of the others become strings of one letter per row; there are at most two of them per task. *Backward*,
   every piece starts at once from a speculative cost vector. Fix-up passes hand each piece the vector that its
   successor has found and rerun it, in step with its former run, until both vectors differ by a constant:
   from there on nothing can change. Passes end when no piece receives a new vector.
3. *Forward*, the stitched vectors tell which edits lie on a cheapest path, and the least letter is taken. Pieces
   start from a speculative state, and are rerun where their predecessor ends in another one.
4. Letters are joined to the rows, which then pass in order through the writer of the result. The audit and
   the hash of a conversation are one value each, so its rows pass one task there, as a stream that is not held.

Defined cases: null roles and texts are one space; a null conversation id is a conversation of its own; rows
without a turn come first. Rows that share a turn are ordered by role, then by a hash of the text; equal rows need
no order. A role without letters, or with another initial than s, u or a, cannot be kept. Very long texts are
passed on singly. An empty table gives no conversations. Only the three named columns and the id are read, so
further columns do not matter.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator, Sequence
from functools import lru_cache
from itertools import groupby

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from airloom.llm.common import bounded_batches, free_name
from airloom.operators.attach import join_keys
from airloom.session import materialize

INSERT, DELETE, REROLE, TRUNCATED = 5, 2, 1, 5
#: State after an inserted or re-roled row. States: 0 nothing yet, 1 after system, 2 after user, 3 after assistant.
_FORCED = (2, 2, 3, 2)
#: State after a kept row, by its initial.
_KEPT = {"s": {0: 1}, "u": {0: 2, 1: 2, 3: 2}, "a": {2: 3}}
_NAMES = {2: "user", 3: "assistant"}
#: Letters of rows: capitals are truncated; o has another initial; b and d must go; - only names its conversation.
_GONE = "bd"
ABSENT = "-"
#: Speculative costs of a piece whose successor is not known yet.
_GUESS = (0, 0, 0, 0)
#: A conversation is held in a task up to so many characters of text; beyond it goes the way of cut ones.
HELD_CHARS = 4 << 20
_SPACE = " \t\n\x0b\x0c\r"

Vector = tuple[int, int, int, int]


# --- one row --------------------------------------------------------------------------

def row_letter(role: str, text: str, seen: bool) -> str:
    """The row as far as costs depend on it."""
    said = text.rstrip(_SPACE)
    if not said:
        return "b"
    if seen:
        return "d"
    initial = role[:1] if role[:1] in _KEPT else "o"
    return initial if said[-1] in ".!?" else initial.upper()


def _edits(letter: str, state: int) -> Iterator[tuple[str, int, int]]:
    """(edit, next state, cost) of a row, least edit first; insertions are apart."""
    if letter == ABSENT:
        yield "", state, 0
        return
    yield "D", state, DELETE
    if letter in _GONE:
        return
    more = TRUNCATED if letter.isupper() else 0
    kept = _KEPT.get(letter.lower(), {}).get(state)
    if kept is not None:
        yield "K", kept, more
    yield "R", _FORCED[state], REROLE + more


def _with_insertions(costs: Sequence[int]) -> Vector:
    """Costs to go when rows may be inserted first."""
    for _ in range(3):
        costs = [min(c, INSERT + costs[_FORCED[q]]) for q, c in enumerate(costs)]
    return tuple(costs)


#: Costs to go at the end of a conversation: complete in states 0 and 3.
END = _with_insertions([0, 10**9, 10**9, 0])


@lru_cache(maxsize=1 << 16)
def _before(after: Vector, letter: str) -> tuple[Vector, int]:
    """Costs to go before a row, from those after it: least cost 0, and what was taken off."""
    costs = _with_insertions([min(c + after[q] for _, q, c in _edits(letter, state)) for state in range(4)])
    least = min(costs)
    return tuple(c - least for c in costs), least


@lru_cache(maxsize=1 << 18)
def _chosen(after: Vector, letter: str, state: int) -> tuple[str, int]:
    """Edits up to and with this row that are least among the cheapest, and the state behind them."""
    before, least = _before(after, letter)
    done = ""
    while True:
        options = [(e, q) for e, q, c in _edits(letter, state) if c + after[q] == before[state] + least]
        if INSERT + before[_FORCED[state]] == before[state]:
            options.append(("I", -1))
        edit, q = min(options)
        done += edit
        if edit != "I":
            return done, q
        state = _FORCED[state]


# --- runs of rows ---------------------------------------------------------------------

def vectors(letters: str, after: Vector) -> list[Vector]:
    """Cost vectors at all places of a run of rows, the one behind its last row last."""
    found = [after]
    for letter in reversed(letters):
        found.append(_before(found[-1], letter)[0])
    return found[::-1]


def rerun(letters: str, after: Vector, former: Vector, first: Vector) -> Vector:
    """The vector before a run from a new vector behind it, given the one (``first``) that ``former`` led to.

    Both runs go in step; as soon as they differ by a constant only, the former result holds.
    """
    for letter in reversed(letters):
        if after == former:
            return first
        after, former = _before(after, letter)[0], _before(former, letter)[0]
    return first if after == former else after


def trace(letters: str, after: Vector, state: int) -> tuple[list[str], int]:
    """Edits of every row of a run, each with the insertions before it, and the state at the end."""
    found = []
    for letter, behind in zip(letters, vectors(letters, after)[1:]):
        edits, state = _chosen(behind, letter, state)
        found.append(edits)
    return found, state


def _ending(state: int) -> str:
    """Insertions that complete a conversation."""
    return {0: "", 1: "II", 2: "I", 3: ""}[state]


# --- results: rows of a conversation go in, in order ------------------------------------

class _Lines:
    """Every row with its edit, and inserted rows."""

    SCHEMA = "position bigint, turn bigint, role string, text string, edit string, fault string"

    def __init__(self):
        self.state = self.position = 0

    def add(self, turn, role, text, letter, edits) -> Iterator[tuple]:
        for edit in edits:
            fault = {"b": "blank", "d": "duplicate"}.get(letter, "truncated" if letter.isupper() else None)
            if edit == "D":
                yield None, turn, role, text, edit, fault
                continue
            self.state = _KEPT[letter.lower()][self.state] if edit == "K" else _FORCED[self.state]
            given = role if edit == "K" else _NAMES[self.state]
            yield (self.position, *((None, given, "", edit, None) if edit == "I" else (turn, given, text, edit, fault)))
            self.position += 1

    def end(self) -> Iterator[tuple]:
        yield from self.add(None, None, None, "o", _ending(self.state))


class _Summary(_Lines):
    """Counts, cost, audit and hash of a conversation; no row is held."""

    SCHEMA = ("gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, "
              "audit string, repaired_sha256 string")

    def __init__(self):
        super().__init__()
        self.turns = self.illegal = self.cost = 0
        self.low = self.high = self.last = None
        self.faults = {"blank": 0, "duplicate": 0, "truncated": 0}
        self.audit: list[str] = []
        self.hash = hashlib.sha256()

    def add(self, turn, role, text, letter, edits) -> Iterator[tuple]:
        if letter == ABSENT:
            return
        if role is not None:
            if self.last is not None and self.last + role[:1] not in ("su", "ua", "au"):
                self.illegal += 1
            self.last = role[:1]
        if turn is not None and turn != self.high:
            self.turns += 1
            self.low, self.high = turn if self.low is None else self.low, turn
        fault = {"b": "blank", "d": "duplicate"}.get(letter, "truncated" if letter.isupper() else None)
        if fault:
            self.faults[fault] += 1
        self.audit.append(edits)
        for position, _, name, line, edit, _ in super().add(turn, role, text, letter, edits):
            self.cost += {"K": 0, "R": REROLE, "D": DELETE, "I": INSERT}[edit]
            if edit != "D":
                self.cost += TRUNCATED if fault == "truncated" and edit != "I" else 0
                self.hash.update(f"{chr(10) if position else ''}{name}:{line}".encode("utf-8", "surrogatepass"))
        yield from ()

    def end(self) -> Iterator[tuple]:
        for _ in super(_Summary, self).end():
            pass
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.turns
        yield gaps, *self.faults.values(), self.illegal, self.cost, "".join(self.audit), self.hash.hexdigest()


def _batched(rows: Iterator[tuple], schema: pa.Schema, n: int = 4096, size: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """Arrow batches of at most ``n`` rows and about ``size`` characters."""
    held, chars = [], 0
    for row in rows:
        held.append(row)
        chars += sum(len(v) for v in row if isinstance(v, str))
        if len(held) == n or chars > size:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)
            held, chars = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(c.to_pylist() for c in batch.columns))


def _arrow(df: DataFrame) -> pa.Schema:
    """The Arrow schema of an empty frame."""
    return df.toArrow().schema


# --- Spark ----------------------------------------------------------------------------

def _scanned(ordered: DataFrame, result: type[_Lines], kind: str) -> DataFrame:
    """Conversations inside a task are finished; rows of the first and the last one, and of those too
    large to be held, are passed on with their place (``part``, ``idx``) and letter."""
    spark = ordered.sparkSession
    passed_on = "part int, idx bigint, at_turn bigint, at_role string, at_text string, letter string, seen boolean, digest binary"
    empty = spark.createDataFrame([], f"conv {kind}, {passed_on}, {result.SCHEMA}")
    schema, n_result = _arrow(empty), len(result.SCHEMA.split(","))

    def finished(conv, held) -> Iterator[tuple]:
        letters = "".join(r[5] for r in held)
        out = result()
        for (_, _, turn, role, text, letter, *_), edits in zip(held, trace(letters, END, 0)[0]):
            for row in out.add(turn, role, text, letter, edits):
                yield conv, *[None] * 8, *row
        for row in out.end():
            yield conv, *[None] * 8, *row

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()

        def out() -> Iterator[tuple]:
            idx, waiting = 0, None  # a whole conversation that may be the last one
            for n, (conv, rows) in enumerate(groupby(_rows(batches), key=lambda r: r[0])):
                if waiting is not None:
                    yield from finished(*waiting)
                held, chars, told, waiting = [], 0, n == 0, None
                seen: set[bytes] = set()
                for _, turn, role, text, present in rows:
                    key = hashlib.blake2b(f"{len(role)}:{role}{text}".encode("utf-8", "surrogatepass"), digest_size=16).digest()
                    letter = row_letter(role, text, key in seen) if present else ABSENT
                    row = (part, idx, turn, role, text, letter, present and key in seen, key)
                    idx += 1
                    if present:
                        seen.add(key)
                    if told:
                        yield conv, *row, *[None] * n_result
                        continue
                    held.append(row)
                    chars += len(text) + 100
                    if chars > HELD_CHARS:
                        told = True
                        yield from ((conv, *r, *[None] * n_result) for r in held)
                        held = []
                if not told:
                    waiting = conv, held
            if waiting is not None:
                yield from ((waiting[0], *r, *[None] * n_result) for r in waiting[1])

        yield from _batched(out(), schema)

    return ordered.mapInArrow(run, empty.schema)


def _per_piece(pieces: DataFrame, fn: Callable[[dict], dict]) -> DataFrame:
    """``fn`` on every piece, the columns staying as they are."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_pylist([{**row, **fn(row)} for row in batch.to_pylist()], schema=batch.schema)

    return pieces.mapInArrow(run, pieces.schema)


def _settled(pieces: DataFrame, given: str, found: str, neighbour, fn: Callable[[dict], dict]) -> DataFrame:
    """Fix-up passes: pieces that receive something new from a neighbour are rerun until none does.

    ``given`` is what a piece started from, ``found`` what it hands on, ``neighbour`` the window function that
    takes it over (null at the end of a conversation, where ``given`` is right from the start).
    """
    order = Window.partitionBy("conv").orderBy("part")
    while True:
        pieces = pieces.withColumn("next", F.coalesce(neighbour(found).over(order), F.col(given)))
        pieces = materialize(pieces)
        if pieces.filter(F.col("next") != F.col(given)).isEmpty():
            return pieces.drop("next")
        pieces = _per_piece(pieces, lambda r: fn(r) if r["next"] != r[given] else {}).withColumn(given, F.col("next")).drop("next")


def _cut_edits(rows: DataFrame) -> DataFrame:
    """(conv, part, idx, letter, edits) of the rows of conversations that may lie in several tasks."""
    placed = rows.select("conv", "part", "idx", "letter", "digest", "seen")
    # Rows that may have been seen in an earlier task: one of each text, conversation and task at most.
    open_ = ~F.col("seen") & ~F.col("letter").isin("b", ABSENT)
    firsts = placed.filter(open_).groupBy("conv", "digest").agg(F.min("part").alias("first_part"))
    judged = join_keys(placed.filter(open_), firsts, ["conv", "digest"]).withColumn(
        "letter", F.when(F.col("part") > F.col("first_part"), F.lit("d")).otherwise(F.col("letter"))).drop("first_part")
    marked = judged.unionByName(placed.filter(~open_))
    listed = F.sort_array(F.collect_list(F.struct("idx", "letter")))  # rows of one task
    # Only the last piece of a conversation has a known vector behind it, only the first a known state.
    series = Window.partitionBy("conv")
    last, first = F.max("part").over(series) == F.col("part"), F.min("part").over(series) == F.col("part")
    vector = lambda v: F.array(*[F.lit(x).cast("bigint") for x in v])
    pieces = marked.groupBy("conv", "part").agg(listed.alias("_rows")).select(
        "conv", "part", F.col("_rows")[0]["idx"].alias("first_idx"),
        F.array_join(F.transform("_rows", lambda r: r["letter"]), "").alias("letters"),
        F.when(last, vector(END)).otherwise(vector(_GUESS)).alias("after"), vector(_GUESS).alias("before"),
        F.when(first, F.lit(0)).otherwise(F.lit(3)).alias("state"), F.lit(0).alias("left"))

    def backward(r):
        return {"before": list(vectors(r["letters"], tuple(r["after"]))[0])}

    def backward_again(r):
        return {"before": list(rerun(r["letters"], tuple(r["next"]), tuple(r["after"]), tuple(r["before"])))}

    def forward(r):
        return {"left": trace(r["letters"], tuple(r["after"]), r.get("next", r["state"]))[1]}

    pieces = _settled(_per_piece(pieces, backward), "after", "before", F.lead, backward_again)
    pieces = _settled(_per_piece(pieces, forward), "state", "left", F.lag, forward)
    kind = pieces.schema["conv"].dataType.simpleString()
    told = pieces.sparkSession.createDataFrame([], f"conv {kind}, part int, idx bigint, letter string, edits string")
    schema = _arrow(told)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out():
            for batch in batches:
                for r in batch.to_pylist():
                    edits = trace(r["letters"], tuple(r["after"]), r["state"])[0]
                    for i, (letter, e) in enumerate(zip(r["letters"], edits)):
                        yield r["conv"], r["part"], r["first_idx"] + i, letter, e
        yield from _batched(out(), schema)

    return pieces.mapInArrow(run, told.schema)


def _repair(df: DataFrame, result: type[_Lines], id_column: str, turn: str, role: str, text: str, present: str | None) -> DataFrame:
    spark = df.sparkSession
    kind = df.schema[id_column].dataType.simpleString()
    rows = df.select(
        F.col(id_column).alias("conv"), F.col(turn).cast("bigint").alias("turn"),
        F.coalesce(F.col(role), F.lit(" ")).alias("role"), F.coalesce(F.col(text), F.lit(" ")).alias("text"),
        (F.coalesce(F.col(present), F.lit(False)) if present else F.lit(True)).alias("present"))
    rows = rows.withColumns({"digest": F.xxhash64("text"), "salt": F.rand(17)})
    order = ["conv", "turn", "role", "digest", "salt"]
    ordered = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    bounded_batches(spark)
    scanned = materialize(_scanned(ordered.select("conv", "turn", "role", "text", "present"), result, kind))
    columns = [c.split()[0] for c in result.SCHEMA.split(", ")]
    whole = scanned.filter("part is null").select("conv", *columns)
    cut = scanned.filter("part is not null").select(
        "conv", "part", "idx", "at_turn", "at_role", "at_text", "letter", "seen", "digest")
    edits = materialize(_cut_edits(cut))
    told = join_keys(cut.select("conv", "part", "idx", "at_turn", "at_role", "at_text"), edits, ["conv", "part", "idx"])
    empty = spark.createDataFrame([], f"conv {kind}, {result.SCHEMA}")
    schema = _arrow(empty)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out():
            for conv, rows in groupby(_rows(batches), key=lambda r: r[0]):
                made = result()
                for _, *row in rows:
                    yield from ((conv, *x) for x in made.add(*row))
                yield from ((conv, *x) for x in made.end())
        yield from _batched(out(), schema)

    streamed = told.repartition("conv").sortWithinPartitions("conv", "part", "idx").select(
        "conv", "at_turn", "at_role", "at_text", "letter", "edits").mapInArrow(run, empty.schema)
    return whole.unionByName(streamed).withColumnRenamed("conv", id_column)


def repaired(
    df: DataFrame, *, id_column: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
) -> DataFrame:
    """Rows of the repaired conversations: the id, ``position`` (null for deleted rows), turn, role, text, ``edit``
    (K, R, D or I) and ``fault`` (blank, duplicate, truncated or null)."""
    return _repair(df, _Lines, id_column, turn, role, text, None)


def summary(
    df: DataFrame, *, id_column: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
    present: str | None = None,
) -> DataFrame:
    """One row per conversation: the id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256.

    Rows whose ``present`` is not true only name their conversation, which then may have no rows at all.
    """
    return _repair(df, _Summary, id_column, turn, role, text, present)


def damage(
    df: DataFrame, present: str, *, id_column: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
) -> DataFrame:
    """Rows as ``crc32(id:turn) % 20`` damages them: 0 drops one (its ``present`` is false), 1 empties the text, 2 takes
    its stops, 3 repeats it, 4 makes it the user's. Nulls are written as one space."""
    def written(c: str):
        return F.coalesce(F.col(c).cast("string"), F.lit(" "))

    kind = free_name(df, "_kind")
    marked = df.select(id_column, turn, written(role).alias(role), written(text).alias(text),
                       F.pmod(F.crc32(F.concat(written(id_column), F.lit(":"), written(turn)).cast("binary")), F.lit(20)).alias(kind))
    k = F.col(kind)
    copies = F.explode(F.when(k == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    return marked.select(
        id_column, turn, F.when(k == 4, F.lit("user")).otherwise(F.col(role)).alias(role),
        F.when(k == 1, F.lit("")).when(k == 2, F.translate(text, ".!?", "")).otherwise(F.col(text)).alias(text),
        (k != 0).alias(present), copies.alias(kind)).drop(kind)
