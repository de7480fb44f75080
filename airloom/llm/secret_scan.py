"""Secrets in texts: a trigram index picks candidate texts for every rule, the rule's regex verifies them.

From each regex a Boolean query over trigrams is derived that every match satisfies. Texts are
indexed shard by shard (a shard is a bounded piece of a partition): the index holds the postings
of the trigrams that some rule asks for, over case-folded UTF-8 bytes. A rule's query is answered
by intersecting and uniting postings, and only the texts it leaves are searched. A rule without
mandatory trigrams searches every text. As the index lives beside its texts, nothing is shuffled.

Defined cases: a null text is empty and has no spans. Offsets are code points, end exclusive.
Matches of one rule are leftmost and do not overlap; different rules may overlap. Repeated rows
are scanned one by one. Other columns never matter.
Texts of any length are scanned whole. An empty table gives no rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from re import _constants as sre
from re import _parser as parser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airloom.llm.common import bounded_batches, chunks, free_name, text_of


@dataclass(frozen=True)
class Rule:
    kind: str
    pattern: str
    #: A match counts when this group has at least so many characters.
    group: int = 0
    least: int = 0


#: The base rules, in the order in which spans with one start are listed.
BASE_RULES = (
    Rule("assign", r"""(?ai:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 18),
    Rule("hex", r"[0-9a-f]{16,}"),
)
MORE_RULES = (
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("google", r"AIza[A-Za-z0-9_-]{35}"),
    Rule("stripe", r"[sr]k_live_[A-Za-z0-9]{16,}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Rule("pem", r"-----BEGIN (?:[A-Z]+ ){0,3}PRIVATE KEY-----[A-Za-z0-9+/=\s]*(?:-----END (?:[A-Z]+ ){0,3}PRIVATE KEY-----)?"),
    Rule("url_login", r"[a-z][a-z0-9+.-]{1,20}://[^\s/:@]{1,64}:[^\s/@]{6,64}@"),
)
RULES = BASE_RULES + MORE_RULES

#: More alternatives than this end a run of literals.
MAX_STRINGS = 64

# A query is True (no condition), a trigram, or ("and" | "or", parts).
Query = bool | bytes | tuple


def _both(op: str, parts: list[Query]) -> Query:
    if op == "or" and any(p is True for p in parts):
        return True
    parts = list(dict.fromkeys(p for p in parts if p is not True))
    return True if not parts else parts[0] if len(parts) == 1 else (op, tuple(parts))


def _of_strings(strings: set[str]) -> Query:
    """What a text holds that has one of the strings."""
    each = []
    for s in sorted(strings):
        b = s.encode()
        each.append(_both("and", [b[i:i + 3] for i in range(len(b) - 2)]))
    return _both("or", each)


def _fold(code: int) -> str:
    c = chr(code)
    return c.lower() if c.isascii() else c


class _Walk:
    """Follows a parsed regex from left to right: ``run`` holds the strings its last part can be."""

    def __init__(self) -> None:
        self.run: set[str] = {""}
        self.found: list[Query] = []
        self.exact = True

    def cut(self) -> None:
        self.found.append(_of_strings(self.run))
        self.run, self.exact = {""}, False

    def add(self, strings: set[str]) -> None:
        if len(self.run) * len(strings) > MAX_STRINGS:
            self.cut()
        if len(strings) > MAX_STRINGS:
            self.cut()
        else:
            self.run = {a + b for a in self.run for b in strings}

    def join(self, other: _Walk) -> None:
        if other.exact:
            self.add(other.run)
        else:
            self.cut()
            self.found += [*other.found, _of_strings(other.run)]

    def items(self, tree) -> _Walk:
        for op, arg in tree:
            if op is sre.LITERAL:
                self.add({_fold(arg)})
            elif op is sre.IN and (chars := _characters(arg)):
                self.add(chars)
            elif op is sre.SUBPATTERN:
                self.join(_Walk().items(arg[-1]))
            elif op is sre.BRANCH:
                ways = [_Walk().items(way) for way in arg[1]]
                if all(w.exact for w in ways):
                    self.add(set().union(*(w.run for w in ways)))
                else:
                    self.cut()
                    self.found.append(_both("or", [w.query() for w in ways]))
            elif op in (sre.MAX_REPEAT, sre.MIN_REPEAT, sre.POSSESSIVE_REPEAT):
                low, high, inner = arg
                once = _Walk().items(inner)
                if low == 0 and high == 1 and once.exact:
                    self.add(once.run | {""})
                    continue
                for _ in range(min(low, 3)):
                    self.join(_Walk().items(inner))
                if low != high or low > 3:
                    self.cut()
            elif op not in (sre.AT, sre.ASSERT, sre.ASSERT_NOT):
                self.cut()
        return self

    def query(self) -> Query:
        return _both("and", [*self.found, _of_strings(self.run)])


def _characters(arg) -> set[str]:
    """The folded characters of a small class; empty for others."""
    out: set[str] = set()
    for op, value in arg:
        if op is sre.LITERAL:
            out.add(_fold(value))
        elif op is sre.RANGE and value[1] - value[0] < 16:
            out |= {_fold(c) for c in range(value[0], value[1] + 1)}
        else:
            return set()
    return out if len(out) <= 8 else set()


def trigram_query(pattern: str) -> Query:
    """The condition on a text's folded trigrams that every text with a match fulfils."""
    return _Walk().items(parser.parse(pattern)).query()


def _trigrams(query: Query) -> set[bytes]:
    if isinstance(query, bytes):
        return {query}
    return set().union(*map(_trigrams, query[1])) if isinstance(query, tuple) else set()


class Index:
    """Postings of a shard: which rows hold a trigram."""

    def __init__(self, texts: pa.Array, wanted: np.ndarray, names: list[bytes]):
        self.rows = len(texts)
        texts = texts.cast(pa.large_string())
        _, offsets, data = texts.buffers()
        ends = np.frombuffer(offsets, np.int64)[texts.offset: texts.offset + self.rows + 1]
        raw = np.frombuffer(data, np.uint8)[ends[0]: ends[-1]] if data else np.zeros(0, np.uint8)
        ends = ends - ends[0]
        self.postings = {n: np.zeros(0, np.int64) for n in names}
        if len(raw) < 3:
            return
        low = _LOWER[raw].astype(np.int32)
        hits = wanted[(low[:-2] << 16) | (low[1:-1] << 8) | low[2:]]
        at = np.flatnonzero(hits)
        row = np.searchsorted(ends, at, "right") - 1
        inside = at + 2 < ends[row + 1]
        pairs = np.unique(hits[at][inside].astype(np.int64) * self.rows + row[inside])
        for i, n in enumerate(names):
            a, b = np.searchsorted(pairs, [(i + 1) * self.rows, (i + 2) * self.rows])
            self.postings[n] = pairs[a:b] - (i + 1) * self.rows

    def find(self, query: Query) -> np.ndarray:
        """The rows that fulfil ``query``, ascending."""
        if query is True:
            return np.arange(self.rows)
        if isinstance(query, bytes):
            return self.postings[query]
        op, parts = query
        found = sorted((self.find(p) for p in parts), key=len)
        out = found[0]
        for more in found[1:]:
            out = np.intersect1d(out, more, assume_unique=True) if op == "and" else np.union1d(out, more)
        return out


_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


@lru_cache(maxsize=8)
def _compiled(rules: tuple[Rule, ...]):
    """Per rule its regex and query; the table from trigram codes to numbers, and their names."""
    queries = [trigram_query(r.pattern) for r in rules]
    names = sorted(set().union(*map(_trigrams, queries)))
    wanted = np.zeros(1 << 24, np.uint8 if len(names) < 255 else np.uint16)
    for i, n in enumerate(names):
        wanted[(n[0] << 16) | (n[1] << 8) | n[2]] = i + 1
    return [re.compile(r.pattern) for r in rules], queries, wanted, names


def spans_of(texts: pa.Array, rules: tuple[Rule, ...]) -> list[list[tuple[int, int, int]]]:
    """Per text its (start, rule number, end), ascending."""
    regexes, queries, wanted, names = _compiled(rules)
    index = Index(texts, wanted, names)
    out: list[list[tuple[int, int, int]]] = [[] for _ in range(len(texts))]
    strings = texts.to_pylist()
    for number, (rule, regex, query) in enumerate(zip(rules, regexes, queries)):
        for row in index.find(query).tolist():
            for m in regex.finditer(strings[row]):
                if m.end(rule.group) - m.start(rule.group) >= rule.least:
                    out[row].append((m.start(), number, m.end()))
    for found in out:
        found.sort()
    return out


SPANS = "array<struct<kind:string,start:bigint,end:bigint>>"


def scan(df: DataFrame, *, text: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``df`` with the column ``spans`` added (``spans_`` if taken): kind, start, end; by start, then rule."""
    name, t = free_name(df, "spans"), free_name(df, "_text")
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, t):
            found = [
                [{"kind": rules[r].kind, "start": a, "end": b} for a, r, b in spans]
                for spans in spans_of(batch.column(t), rules)
            ]
            columns = [batch.column(c) for c in batch.schema.names if c != t]
            names = [c for c in batch.schema.names if c != t]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(found, kind)], names=[*names, name])

    bounded_batches(df.sparkSession)
    fed = df.withColumn(t, text_of(text))
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)
    return fed.mapInArrow(run, f"{fields}, `{name}` {SPANS}")


def redact(df: DataFrame, *, text: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``df`` with every span of its text replaced by ``[kind]``; overlapping spans become one."""
    t = free_name(df, "_text")

    def clean(s: str, spans) -> str:
        out, at, end = [], 0, 0
        for a, r, b in spans:
            if a >= end:
                out += [s[at:a], f"[{rules[r].kind}]"]
            at = end = max(end, b)
        return "".join(out) + s[at:]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, t):
            found = spans_of(batch.column(t), rules)
            place = batch.schema.get_field_index(text)
            old, whole = batch.column(place).to_pylist(), batch.column(t).to_pylist()
            new = [clean(w, f) if f else o for o, w, f in zip(old, whole, found)]
            batch = batch.set_column(place, text, pa.array(new, batch.schema.field(place).type))
            yield batch.drop_columns([t])

    bounded_batches(df.sparkSession)
    return df.withColumn(t, text_of(text)).mapInArrow(run, df.schema)


def digest(df: DataFrame, id_column: str = "doc_id", spans: str = "spans") -> DataFrame:
    """Counts and digests of ``scan``'s spans per row."""
    base = [r.kind for r in BASE_RULES]

    def listed(s):
        return F.array_join(F.transform(s, lambda x: F.concat_ws(
            ":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")

    def of(kinds):
        return F.filter(spans, lambda x: x["kind"].isin(kinds))

    return df.select(
        id_column, *(F.size(of([k])).cast("long").alias(f"n_{k}") for k in base),
        F.sha2(listed(of(base)).cast("binary"), 256).alias("base_sha256"), listed(F.col(spans)).alias("spans"),
    )
