from __future__ import annotations

import hashlib
import itertools
import random
import re
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from airloom.llm import conversation_repair as cr
from airloom.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"
SPACE = " \t\n\x0b\x0c\r"
SCHEMA = "conv_id long, turn long, role string, text string"


def faults(rows):
    found, seen = [], set()
    for role, text in rows:
        if not text.strip(SPACE):
            found.append("blank")
        elif (role, text) in seen:
            found.append("duplicate")
        else:
            found.append(None if text.rstrip(SPACE)[-1] in ".!?" else "truncated")
        seen.add((role, text))
    return found


def cheapest(rows):
    """(cost, audit, lines): all states forward, row by row, keeping the least (cost, audit) of each."""
    step = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}
    name = {"u": "user", "a": "assistant"}

    def inserted(best):
        for _ in range(3):
            for state, (cost, audit, lines) in list(best.items()):
                for role in "ua":
                    to = step.get((state, role))
                    if to and (to not in best or (cost + 5, audit + "I") < best[to][:2]):
                        best[to] = cost + 5, audit + "I", lines + ((name[role], ""),)
        return best

    best = {"": (0, "", ())}
    for (role, text), fault in zip(rows, faults(rows)):
        new = {}
        for state, (cost, audit, lines) in inserted(dict(best)).items():
            options = [(cost + 2, audit + "D", lines, state)]
            if fault not in ("blank", "duplicate"):
                more = 5 if fault else 0
                if role and step.get((state, role[0])):
                    options.append((cost + more, audit + "K", lines + ((role, text),), step[state, role[0]]))
                options += [(cost + 1 + more, audit + "R", lines + ((name[r], text),), step[state, r])
                            for r in "ua" if step.get((state, r))]
            for c, a, ls, to in options:
                if to not in new or (c, a) < new[to][:2]:
                    new[to] = c, a, ls
        best = new
    ends = inserted(dict(best))
    return min((ends[s] for s in ("", "a") if s in ends), key=lambda x: x[:2])


def digest(turns, rows):
    """The columns of a conversation, plainly."""
    kinds = faults(rows)
    cost, audit, lines = cheapest(rows)
    known = [t for t in turns if t is not None]
    gaps = max(known) - min(known) + 1 - len(set(known)) if known else 0
    illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    text = "\n".join(f"{r}:{t}" for r, t in lines)
    return (gaps, *(kinds.count(k) for k in ("blank", "duplicate", "truncated")), illegal, cost, audit,
            hashlib.sha256(text.encode()).hexdigest())


def damaged(rows):
    """conv_id -> (turns, rows) after damage."""
    found = defaultdict(list)
    for conv, turn, role, text in rows:
        written = [" " if v is None else str(v) for v in (conv, turn, role, text)]
        kind = zlib.crc32(f"{written[0]}:{written[1]}".encode()) % 20
        role, text = written[2:]
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        role = "user" if kind == 4 else role
        found[conv] += [(turn, role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    out = {}
    for conv, lines in found.items():
        lines.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
        out[conv] = digest([r[0] for r in lines], [r[1:] for r in lines])
    return out


def by_id(df):
    rows = df.collect()
    assert len({r[0] for r in rows}) == len(rows)
    return {r[0]: tuple(r)[1:] for r in rows}


def test_cheapest_equals_every_list_of_edits():
    rng = random.Random(3)
    order, name = re.compile("(s?(ua)+)?"), {"u": "user", "a": "assistant"}
    for _ in range(60):
        rows = [(rng.choice(["system", "user", "assistant", "tool", " "]), rng.choice(["", "a.", "b", "c!", "a."])) for _ in range(rng.randint(0, 3))]
        found, best = faults(rows), []
        for edits in itertools.product(["K", "Ru", "Ra", "D"], repeat=len(rows)):
            for places in itertools.product(["", "u", "a", "ua", "au"], repeat=len(rows) + 1):
                cost, audit, roles, good = 0, "", "", True
                for i in range(len(rows) + 1):
                    cost, audit, roles = cost + 5 * len(places[i]), audit + "I" * len(places[i]), roles + places[i]
                    if i == len(rows):
                        break
                    e, fault = edits[i], found[i]
                    good &= e == "D" or fault not in ("blank", "duplicate")
                    cost += {"K": 0, "R": 1, "D": 2}[e[0]] + (5 if e != "D" and fault == "truncated" else 0)
                    audit += e[0]
                    roles += "" if e == "D" else e[1] if e[0] == "R" else rows[i][0][0]
                if good and order.fullmatch(roles):
                    best.append((cost, audit))
        assert min(best) == cheapest(rows)[:2]
        letters = "".join(cr.row_letter(r, t, f == "duplicate") for (r, t), f in zip(rows, found))
        edits, state = cr.trace(letters, cr.END, 0)
        assert "".join(edits) + cr._ending(state) == min(best)[1]
    assert name  # roles by letter


def test_runs_that_differ_by_a_constant_end_early():
    rng = random.Random(8)
    for _ in range(300):
        letters = "".join(rng.choice("suaoUASObd") for _ in range(rng.randint(0, 30)))
        former, after = ([tuple(x - min(v) for x in v) for v in [[rng.randint(0, 9) for _ in range(4)]]][0] for _ in range(2))
        first = cr.vectors(letters, former)[0]
        assert cr.rerun(letters, after, former, first) == cr.vectors(letters, after)[0]


def test_query_equals_plain_repair(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    want = damaged(rows)
    got = QUERIES["op12_conversation_repair"](spark, FOLDER)
    assert got.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    assert by_id(got) == want


def odd_conversations():
    rng = random.Random(5)
    rows = [(1, 0, "user", "same."), (1, 0, "user", "same."), (1, None, None, None), (2, None, "user", None), (2, None, "user", "x"),
            (None, 3, "assistant", "no id."), (None, 1, "user", "q?"), (3, 5, "tool", "t."), (3, 9, "User", "u."), (4, 1, "", "nothing."),
            (5, 0, "user", "word " * 200_000), (5, 1, "assistant", "y" * 100_000 + "!"), (6, 0, "system", "only."), (-7, -3, "user", "é日🙂."), (-7, 2, "assistant", " ")]
    texts = ["a.", "b", "", "c!", "d?", "e.", " \t"]
    for conv in range(10, 60):
        rows += [(conv, t, rng.choice(["system", "user", "assistant", "user", "assistant", "tool"]), rng.choice(texts)) for t in range(rng.randint(0, 12))]
    return rows


@pytest.fixture
def many_tasks(spark):
    kept = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.coalescePartitions.enabled", "spark.sql.shuffle.partitions")}
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "7")
    yield
    for k, v in kept.items():
        spark.conf.set(k, v)


def test_odd_rows_and_a_conversation_over_all_tasks(spark, many_tasks):
    rng = random.Random(6)
    hot = [(33, 1000 + t, rng.choice(["user", "assistant", "system", "other"]), f"line {rng.randint(0, 900)}" + rng.choice([".", "", "!", "?"])) for t in range(3000)]
    rows = odd_conversations() + hot + [(8, 4, "user", "equal rows.")] * 500
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA + ", conv int, letter string")
    want = {}
    for conv in {r[0] for r in rows}:
        mine = sorted((r for r in rows if r[0] == conv), key=lambda r: (r[1] is not None, r[1] or 0, r[2] or " "))
        mine = [(t, " " if r is None else r, " " if x is None else x) for _, t, r, x in mine]
        want[conv] = digest([m[0] for m in mine], [m[1:] for m in mine])
    # Equal turns lie in the order of role and hash; the cases above with a tie are equal rows or blank ones.
    got = by_id(cr.summary(df))
    assert got == want
    assert by_id(cr.summary(cr.damage(df, "present"), present="present")) == damaged(rows)
    lines = defaultdict(list)
    for r in cr.repaired(df).collect():
        if r["edit"] != "D":
            lines[r["conv_id"]].append((r["position"], f"{r['role']}:{r['text']}"))
    for conv, found in want.items():
        mine = sorted(lines[conv])
        assert [p for p, _ in mine] == list(range(len(mine)))
        assert hashlib.sha256("\n".join(x for _, x in mine).encode()).hexdigest() == found[-1]


def test_large_conversations_go_the_way_of_cut_ones(spark, many_tasks, monkeypatch):
    rows = odd_conversations()
    df = spark.createDataFrame(rows, SCHEMA)
    want = by_id(cr.summary(df))
    monkeypatch.setattr(cr, "HELD_CHARS", 300)
    assert by_id(cr.summary(df.coalesce(1))) == want


def test_empty_tables_and_dropped_rows(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert cr.summary(none).count() == 0 and cr.repaired(none).count() == 0
    df = spark.createDataFrame([(1, 0, "user", "a."), (2, 0, "user", "b.")], SCHEMA).withColumn("there", F.col("conv_id") == 2)
    empty = hashlib.sha256(b"").hexdigest()
    got = by_id(cr.summary(df, present="there"))
    assert got[1] == (0, 0, 0, 0, 0, 0, "", empty) and got[2][5:7] == (2, "D")
