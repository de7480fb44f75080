"""Quality rules whose cutoffs are certified on labelled documents, by DataFrame functions only.

Every rule rejects a document whose measure exceeds a cutoff. For each stratum (a language, say)
the labelled documents are a holdout: a cutoff is certified when the exact binomial tail shows
that it rejects at most ``max_false`` of the good documents,

    P(Binomial(good, max_false) <= good documents rejected) <= delta / (strata * rules).

Cutoffs are tested from the loosest to the strictest and testing ends at the first that fails,
so that the correction is needed for strata and rules only, and any certified cutoff may then be
chosen freely. The chosen one rejects the most bad documents beyond good ones; ties go to the
looser. Without such a cutoff the rule is off in that stratum. ``max_false`` holds for each rule,
so a stratum loses at most ``len(RULES) * max_false`` of its good documents, at confidence
``1 - delta``.

Defined cases: a null text counts as empty and an empty one has no words, so it fails the base
rule. A null stratum is the stratum "". Documents without a label, or with both, do not take part
in the certification. Repeated rows are judged one by one. Texts
of any length are measured whole. An empty table gives no rows. Without labels only the base rule works.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from airloom.llm.common import free_name, one_label, text_of
from airloom.session import materialize

SPACES = r"[\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
SHOUTS = "!?"

MAX_FALSE = 0.01
DELTA = 0.05


@dataclass(frozen=True)
class Rule:
    """A document is rejected when ``measure`` (SQL over the counts) exceeds the cutoff."""

    name: str
    measure: str
    #: From loose to strict.
    cutoffs: tuple[float, ...]


def _steps(high: float, low: float, n: int) -> tuple[float, ...]:
    return tuple(round(high - (high - low) * i / n, 6) for i in range(n + 1))


RULES = (
    Rule("symbols", "n_symbols / n_words", _steps(1.0, 0.05, 19)),
    Rule("repeats", "n_repeat_words / n_words", _steps(0.5, 0.05, 9)),
    Rule("dup_lines", "n_dup_lines / n_lines", _steps(0.9, 0.1, 16)),
    Rule("capitals", "n_capitals / word_chars", _steps(0.9, 0.1, 16)),
    Rule("shouts", "n_shouts / n_words", _steps(2.0, 0.1, 19)),
    Rule("long_words", "word_chars / n_words", _steps(20.0, 6.0, 14)),
    Rule("short_words", "-word_chars / n_words", _steps(-1.0, -3.5, 10)),
)

BASE = "n_words < 50 OR 100 * n_repeat_words > 50 * n_words"
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
          "n_lines", "n_capitals", "n_shouts")


def _removed(text: Column, characters: str) -> Column:
    return (F.length(text) - F.length(F.translate(text, characters, ""))).cast("long")


def measure(df: DataFrame, text: str, into: str) -> DataFrame:
    """``df`` with the struct ``into`` of COUNTS added, computed row by row without a shuffle.

    Store the result before filtering on it: a filter pushed below would repeat this work.
    Repeated three-word windows are found by sorting the windows of a document: equal ones
    become neighbours. The words they cover are counted once.
    """
    t, w, s, p = (free_name(df, c) for c in ("_text", "_words", "_windows", "_starts"))
    n = F.size(w)
    df = df.withColumn(t, text_of(text))
    df = df.withColumn(w, F.array_remove(F.split(t, SPACES, -1), ""))
    window = F.transform(
        F.when(n >= 3, F.sequence(F.lit(0), n - 3)).otherwise(F.array().cast("array<int>")),
        lambda i: F.struct(
            F.concat_ws(" ", F.get(F.col(w), i), F.get(F.col(w), i + 1), F.get(F.col(w), i + 2)).alias("t"),
            i.alias("i"),
        ),
    )
    df = df.withColumn(s, F.sort_array(window))

    def repeated(x, i):
        def same(j):
            return F.coalesce(F.get(F.col(s), j)["t"] == x["t"], F.lit(False))
        return same(i - 1) | same(i + 1)

    df = df.withColumn(p, F.transform(F.filter(F.col(s), repeated), lambda x: x["i"]))
    covered = F.array_distinct(F.flatten(F.transform(F.col(p), lambda i: F.array(i, i + 1, i + 2))))
    lines = F.filter(F.split(t, "\n", -1), lambda x: F.trim(x, F.lit(" \t\n\x0b\f\r")) != "")
    counts = {
        "n_words": n,
        "word_chars": F.length(F.array_join(w, "")),
        "n_symbols": _removed(F.col(t), SYMBOLS),
        "n_dup_lines": F.size(lines) - F.size(F.array_distinct(lines)),
        "n_repeat_words": F.size(covered),
        "n_lines": F.size(lines),
        "n_capitals": _removed(F.col(t), CAPITALS),
        "n_shouts": _removed(F.col(t), SHOUTS),
    }
    return df.withColumn(into, F.struct(*(c.cast("long").alias(k) for k, c in counts.items()))).drop(t, w, s, p)


def _value(rule: Rule) -> Column:
    """The measure; null where its base is 0."""
    top, base = rule.measure.split(" / ")
    return F.expr(f"CASE WHEN {base} > 0 THEN CAST({top} AS DOUBLE) / {base} END")


def tail(k: str, n: str, p: float) -> Column:
    """P(Binomial(n, p) <= k), summed exactly, term after term, in logarithms.

    Terms rise up to n * p; a ``k`` beyond that has a tail of a half or so, and 1 is returned.
    """
    odds = F.lit(p / (1 - p))

    def add(acc, i):
        term = acc["term"] + F.log((F.col(n) - i + 1) / i * odds)
        high, low = F.greatest(acc["sum"], term), F.least(acc["sum"], term)
        return F.struct(term.alias("term"), (high + F.log1p(F.exp(low - high))).alias("sum"))

    first = F.col(n) * F.log(F.lit(1 - p))
    total = F.aggregate(
        F.sequence(F.lit(1).cast("long"), F.col(k).cast("long"), F.lit(1).cast("long")),
        F.struct(first.alias("term"), first.alias("sum")), add, lambda acc: F.exp(acc["sum"]),
    )
    return F.when(F.col(k) > F.col(n) * p, 1.0).when(F.col(k) < 1, F.exp(first)).otherwise(total)


def certify(
    measured: DataFrame, rules: tuple[Rule, ...] = RULES, max_false: float = MAX_FALSE, delta: float = DELTA
) -> DataFrame:
    """Chosen cutoffs: (stratum, one double per rule, null where the rule is off).

    ``measured``: stratum, label, and the columns of COUNTS, of labelled documents that pass the
    base rule. Only counts per (stratum, rule, number of cutoffs exceeded) are shuffled.
    """
    def exceeded(r: Rule) -> Column:
        value = _value(r)
        return F.size(F.filter(F.array(*map(F.lit, r.cutoffs)), lambda c: value > c))

    each = F.array(*(F.struct(F.lit(r.name).alias("rule"), exceeded(r).alias("over")) for r in rules))
    seen = (
        measured.select("stratum", "label", F.explode(each).alias("x"))
        .groupBy("stratum", "x.rule", "x.over")
        .agg(F.sum("label").alias("good"), F.sum(1 - F.col("label")).alias("bad"))
    )
    seen = materialize(seen)
    strata = max(1, seen.select("stratum").distinct().count())
    grid = F.create_map(*(x for r in rules for x in (F.lit(r.name), F.array(*map(F.lit, r.cutoffs)))))
    # Cutoffs run from high to low, so a document that exceeds 3 of them exceeds the last 3.
    cut = (
        seen.withColumn("cutoffs", grid[F.col("rule")])
        .groupBy("stratum", "rule", "cutoffs")
        .agg(F.collect_list(F.struct("over", "good", "bad")).alias("bins"), F.sum("good").alias("n"))
        .select("stratum", "rule", "bins", "n", F.posexplode("cutoffs").alias("at", "cutoff"), F.size("cutoffs").alias("m"))
    )

    def rejected(what):
        kept = F.filter("bins", lambda b: b["over"] >= F.col("m") - F.col("at"))
        return F.aggregate(kept, F.lit(0).cast("long"), lambda acc, b: acc + b[what])

    cut = cut.withColumns({"k": rejected("good"), "gain": rejected("bad")})
    fails = tail("k", "n", max_false) > delta / (strata * len(rules))
    choice = F.struct((F.col("gain") - F.col("k")).alias("net"), (-F.col("at")).alias("loose"), "cutoff", "at")
    chosen = (
        cut.withColumn("fails", fails)
        .groupBy("stratum", "rule")
        .agg(F.min(F.when(F.col("fails"), F.col("at"))).alias("end"), F.collect_list(choice).alias("all"))
        .select("stratum", "rule", F.array_max(F.filter(
            "all", lambda c: (c["net"] > 0) & (F.col("end").isNull() | (c["at"] < F.col("end"))))).alias("best"))
    )
    return chosen.groupBy("stratum").pivot("rule", [r.name for r in rules]).agg(F.first("best.cutoff"))


def judge(
    df: DataFrame,
    labels: DataFrame,
    *,
    id_column: str = "doc_id",
    text: str = "text",
    stratum: str = "lang",
    label: str = "quality",
    rules: tuple[Rule, ...] = RULES,
    max_false: float = MAX_FALSE,
    delta: float = DELTA,
    carry: bool = False,
) -> DataFrame:
    """One row per input row: the columns of COUNTS, ``base_failed``, ``failed_rules`` (names) and ``kept``.

    With ``carry`` the rows are those of ``df`` itself with one struct column ``judged`` added
    (``judged_`` if taken), else the id and those columns alone. Texts are measured once: what is
    measured is stored, and the cutoffs are joined to it.
    """
    m, j = free_name(df, "_counts"), free_name(df, "judged")
    key = F.coalesce(F.col(stratum).cast("string"), F.lit("")) if stratum in df.columns else F.lit("")
    s = free_name(df, "_stratum")
    rows = df if carry else df.select(id_column, text, *([stratum] if stratum in df.columns else []))
    rows = measure(rows.withColumn(s, key), text, m)
    rows = materialize(rows if carry else rows.select(id_column, s, m))
    known = one_label(labels, id_column, label)
    holdout = (
        rows.select(F.col(id_column).alias("id"), F.col(s).alias("stratum"), f"{m}.*")
        .join(known, "id").filter(f"NOT ({BASE})")
    )
    cutoffs = materialize(certify(holdout, rules, max_false, delta))
    c = free_name(df, "_cutoffs")
    cutoffs = cutoffs.select(F.col("stratum").alias(s), F.struct(*(r.name for r in rules)).alias(c))
    rows = rows.join(cutoffs, s, "left")

    def on(expression: str) -> Column:
        """The expression over the counts inside their struct."""
        for name in sorted(COUNTS, key=len, reverse=True):
            expression = expression.replace(name, f"{m}.{name}")
        return F.expr(expression)

    def over(r: Rule) -> Column:
        top, base = r.measure.split(" / ")
        return F.try_divide(on(top).cast("double"), on(base)) > F.col(f"{c}.{r.name}")

    failed = F.array_compact(F.array(*(F.when(over(r), F.lit(r.name)) for r in rules)))
    base = on(BASE)
    verdict = F.struct(
        *(F.col(f"{m}.{k}").alias(k) for k in COUNTS), base.alias("base_failed"),
        failed.alias("failed_rules"), (~base & (F.size(failed) == 0)).alias("kept"),
    )
    if carry:
        return rows.select(*df.columns, verdict.alias(j))
    return rows.select(id_column, verdict.alias(j)).select(id_column, f"{j}.*")
