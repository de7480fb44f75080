"""Exact quantiles of arbitrarily large columns.

The built-in exact ``percentile`` keeps every distinct value of a group in one task. Here
each quantile is first bracketed by a bounded-size sketch, the rows below and inside the
bracket are counted exactly, and the bracket is narrowed until its interior is small enough
to sort in memory. Every step is one scan with map-side aggregation; up to some 25 million
rows per group three scans suffice.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from airloom.functions.expr import clean_double
from airloom.operators.attach import attach, join_keys
from airloom.session import materialize

ACCURACY = 10_000
GRID = 200
MAX_INTERIOR = 10_000
# Infinities are searched as the largest finite numbers, which have room on either side.
_LARGEST = "double('1.7976931348623157E308')"


def approx_quantiles(
    df: DataFrame, columns: Sequence[str], probs: Sequence[float], *,
    keys: Sequence[str] = (), accuracy: int = ACCURACY, beside: Sequence[Column] = (),
) -> DataFrame:
    """Per column an array of approximate quantiles, in one pass, and the aggregates ``beside`` them."""
    return df.groupBy(*keys).agg(
        *[F.percentile_approx(c, list(probs), accuracy).cast("array<double>").alias(c)
          for c in columns], *beside
    )


def exact_quantiles(
    df: DataFrame, columns: Sequence[str], probs: Sequence[float], *,
    keys: Sequence[str] = (), max_interior: int = MAX_INTERIOR, beside: Sequence[Column] = (),
) -> DataFrame:
    """Per column an array of exact, linearly interpolated quantiles (NULL if no values).

    ``beside`` are named aggregates of the input that the first scan computes as well; they follow as columns.

    NaN counts as missing, infinities are values. Whether the values are few enough to be
    sorted whole or have to be searched makes no difference to the result.

    Several scans are made, so ``df`` should be a stored table or cheap to recompute.
    """
    search = _Search(
        df.select(*keys, *[_finite(c) for c in columns]),
        list(columns), [float(p) for p in probs], list(keys),
    )
    finite = {f"_v_{i}": _finite(c) for i, c in enumerate(columns)}
    if search.sketch(df.withColumns(finite) if finite else df, beside) <= max_interior:
        return search.with_beside(search.whole_lists())
    before = None
    while (largest := search.count()) > max_interior:
        if before is not None and largest >= before:
            raise RuntimeError("quantile brackets no longer get narrower")
        before = largest
        search.narrow()
    return search.with_beside(search.interior_lists())


def _finite(column: str) -> Column:
    value = clean_double(column)
    ends = F.greatest(F.least(value, F.expr(_LARGEST)), F.expr(f"-{_LARGEST}"))
    return F.when(value.isNotNull(), ends).alias(column)


@dataclass(frozen=True)
class _Slot:
    """One wanted quantile of one column."""

    number: int
    column: str
    prob: float

    @property
    def value(self) -> str:
        return f"`{self.column}`"


def _number(value: float | int) -> str:
    if isinstance(value, int):
        return f"{value}L"
    return f"double('{value!r}')"


class _Search:
    """Brackets of all wanted quantiles, one small stored row per key.

    Per slot, ``lo`` and ``hi`` are the open ends of the bracket, ``upto`` the number of
    values up to and including ``lo`` and ``inside`` the number strictly between the ends;
    ``lo2`` and ``hi2`` are proposed ends that have not been counted yet. Without keys there
    is a single state row, whose values are put into the expressions as literals.
    """

    def __init__(self, data: DataFrame, columns: list[str], probs: list[float], keys: list[str]):
        self.data, self.columns, self.probs, self.keys = data, columns, probs, keys
        pairs = [(c, p) for c in columns for p in probs]
        self.slots = [_Slot(i, c, p) for i, (c, p) in enumerate(pairs)]
        self.state: DataFrame | None = None
        self.only: Row | None = None
        self.literal = not keys
        self.first: DataFrame | None = None
        self.constants: dict[str, Column] = {}

    # expressions ----------------------------------------------------------------------

    def ref(self, name: str) -> str:
        """A state value: its column, or its literal when there is only one row."""
        if not self.literal:
            return name
        value = self.only[name]
        return "CAST(NULL AS DOUBLE)" if value is None else _number(value)

    def size(self, column: str) -> str:
        return self.ref(f"_n_{self.columns.index(column)}")

    def get(self, field: str, slot: _Slot) -> str:
        return self.ref(f"_{field}_{slot.number}")

    def rank(self, slot: _Slot, up: bool) -> str:
        exact = f"(({self.size(slot.column)} - 1) * double('{slot.prob!r}'))"
        return f"{'ceil' if up else 'floor'}{exact}"

    def inside(self, slot: _Slot) -> str:
        return f"{slot.value} > {self.get('lo', slot)} AND {slot.value} < {self.get('hi', slot)}"

    def open_rows(self, slot: _Slot) -> str:
        """Interior size if a wanted rank lies in the interior, else 0."""
        start, length = self.get("upto", slot), self.get("inside", slot)
        return (
            f"CASE WHEN {self.size(slot.column)} > 0 AND {self.rank(slot, True)} >= {start} "
            f"AND {self.rank(slot, False)} < {start} + {length} THEN {length} ELSE 0L END"
        )

    # passes ---------------------------------------------------------------------------

    def _keep(self, state: DataFrame, sizes: Callable[[], list[str]] | None = None) -> int:
        """Make ``state`` the current state; returns the largest of ``sizes`` over all keys."""
        if sizes:
            self.literal = False
            state = state.selectExpr("*", f"greatest(0L, {', '.join(sizes())}) AS _worst")
            self.literal = not self.keys
        if not self.keys:
            self.only = state.first()
            return self.only["_worst"] if sizes else 0
        stored = materialize(state)
        self.state = stored.drop("_worst")
        return (stored.agg(F.max("_worst")).first()[0] or 0) if sizes else 0

    def _aggregate(self, aggregates: list[str], rows: DataFrame | None = None) -> DataFrame:
        """Aggregate the data per key, beside the key's state."""
        rows = self._rows() if rows is None else rows
        made = rows.groupBy(*self.keys).agg(*[F.expr(a) for a in aggregates])
        # Keys may have lost all rows to a filter.
        return join_keys(self.state, made, self.keys, "left") if self.keys else made

    def _rows(self) -> DataFrame:
        """The data with the state of its key."""
        if not self.keys:
            return self.data
        return attach(self.data, self.state, self.keys, salt_on=self.columns)

    def _sizes(self) -> list[str]:
        return [f"{self.size(c)} AS _n_{i}" for i, c in enumerate(self.columns)]

    def sketch(self, rows: DataFrame, beside: Sequence[Column] = ()) -> int:
        """Count each column and propose a first bracket around each quantile; returns the
        largest column size. ``rows`` has the values as ``_v_0`` and so on, and what ``beside`` aggregates."""
        reach = 2.0 / ACCURACY
        ends = [e for p in self.probs for e in (max(0.0, p - reach), min(1.0, p + reach))]
        points = ", ".join(f"double('{e!r}')" for e in ends)
        made = rows.groupBy(*self.keys).agg(*[
            F.expr(a) for i in range(len(self.columns)) for a in (
                f"count(_v_{i}) AS _n_{i}",
                f"percentile_approx(_v_{i}, array({points}), {ACCURACY}) AS _g_{i}")
        ], *beside)
        names = made.columns[len(made.columns) - len(beside):] if beside else []
        fields = [f"_n_{i}" for i in range(len(self.columns))]
        for s in self.slots:
            i, p = self.columns.index(s.column), self.probs.index(s.prob)
            fields += [
                f"double('-Infinity') AS _lo_{s.number}", f"double('Infinity') AS _hi_{s.number}",
                f"0L AS _upto_{s.number}", f"_n_{i} AS _inside_{s.number}",
                f"_g_{i}[{2 * p}] AS _lo2_{s.number}", f"_g_{i}[{2 * p + 1}] AS _hi2_{s.number}",
            ]
        state = made.selectExpr(*self.keys, *fields, *[f"`{n}`" for n in names])
        largest = self._keep(state, lambda: [self.size(c) for c in self.columns])
        if names and self.keys:
            self.first, self.state = self.state.select(*self.keys, *[f"`{n}`" for n in names]), self.state.drop(*names)
        elif names:
            kinds = {f.name: f.dataType for f in state.schema}
            self.constants = {n: F.lit(self.only[n]).cast(kinds[n]) for n in names}
        return largest

    def with_beside(self, found: DataFrame) -> DataFrame:
        """The result with the other aggregates of the first scan."""
        if self.first is not None:
            return join_keys(found, self.first, self.keys)
        return found.withColumns(self.constants) if self.constants else found

    def count(self) -> int:
        """Count around the proposed ends; keep an old end where the new one would lose a
        wanted rank. Returns the largest interior that still has to be searched."""
        counted = self._aggregate([
            f"count_if({s.value} {sign} {self.get(end, s)}) AS _{name}_{s.number}"
            for s in self.slots
            for end, sign, name in (("lo2", "<", "lt_lo"), ("lo2", "<=", "le_lo"),
                                    ("hi2", "<", "lt_hi"), ("hi2", "<=", "le_hi"))
        ])
        fields = self._sizes()
        for s in self.slots:
            n = s.number
            lo_ok = f"coalesce({self.get('lo2', s)} IS NOT NULL AND _lt_lo_{n} <= {self.rank(s, False)}, false)"
            hi_ok = f"coalesce({self.get('hi2', s)} IS NOT NULL AND _le_hi_{n} > {self.rank(s, True)}, false)"
            upto = f"if({lo_ok}, _le_lo_{n}, {self.get('upto', s)})"
            below_hi = f"if({hi_ok}, _lt_hi_{n}, {self.get('upto', s)} + {self.get('inside', s)})"
            fields += [
                f"if({lo_ok}, {self.get('lo2', s)}, {self.get('lo', s)}) AS _lo_{n}",
                f"if({hi_ok}, {self.get('hi2', s)}, {self.get('hi', s)}) AS _hi_{n}",
                f"{upto} AS _upto_{n}", f"greatest({below_hi} - {upto}, 0L) AS _inside_{n}",
            ]
        return self._keep(
            counted.selectExpr(*self.keys, *fields),
            lambda: [self.open_rows(s) for s in self.slots],
        )

    def narrow(self) -> None:
        """Sketch each interior on a grid and propose the grid points around the quantile."""
        grid = f"array({', '.join(f'{i / GRID!r}D' for i in range(GRID + 1))})"
        sketched = self._aggregate([
            f"percentile_approx(CASE WHEN {self.inside(s)} THEN {s.value} END, {grid}, {GRID * 20}) "
            f"AS _grid_{s.number}" for s in self.slots
        ])
        fields = self._sizes()
        for s in self.slots:
            n = s.number
            fields += [f"{self.get(f, s)} AS _{f}_{n}" for f in ("lo", "hi", "upto", "inside")]
            last = f"greatest({self.get('inside', s)} - 1, 1L)"
            for end, up in (("lo2", False), ("hi2", True)):
                share = f"({self.rank(s, up)} - {self.get('upto', s)}) / {last} * {GRID}"
                step = f"ceil({share}) + 1" if up else f"floor({share}) - 1"
                old = self.get("hi" if up else "lo", s)
                fields.append(
                    f"coalesce(if({step} BETWEEN 0 AND {GRID}, get(_grid_{n}, CAST({step} AS INT)), NULL), "
                    f"{old}) AS _{end}_{n}")
        self._keep(sketched.selectExpr(*self.keys, *fields))

    # results --------------------------------------------------------------------------

    def _blend(self, slot: _Slot, at) -> str:
        low, high = self.rank(slot, False), self.rank(slot, True)
        weight = f"(({self.size(slot.column)} - 1) * double('{slot.prob!r}') - {low})"

        def value(rank: str) -> str:
            found = at(rank)
            return (f"(CASE WHEN {found} >= {_LARGEST} THEN double('Infinity') "
                    f"WHEN {found} <= -{_LARGEST} THEN double('-Infinity') ELSE {found} END)")

        return (f"CASE WHEN {low} = {high} OR {value(low)} = {value(high)} THEN {value(low)} "
                f"ELSE {value(low)} + ({value(high)} - {value(low)}) * {weight} END")

    def _results(self, lists: DataFrame, at) -> DataFrame:
        out = []
        for c in self.columns:
            parts = [self._blend(s, lambda rank, s=s: at(s, rank)) for s in self.slots if s.column == c]
            out.append(f"CASE WHEN {self.size(c)} > 0 THEN array({', '.join(parts)}) END AS `{c}`")
        return lists.selectExpr(*self.keys, *out)

    def whole_lists(self) -> DataFrame:
        """Quantiles from the sorted columns: no group has more than ``max_interior`` rows."""
        lists = self._aggregate([
            f"sort_array(collect_list(`{c}`)) AS _list_{i}" for i, c in enumerate(self.columns)],
            self.data)
        return self._results(lists, lambda s, rank: (
            f"get(_list_{self.columns.index(s.column)}, CAST({rank} AS INT))"))

    def interior_lists(self) -> DataFrame:
        """Quantiles from the sorted interiors, each at most ``max_interior`` rows."""
        hits = {s: f"(({self.open_rows(s)}) > 0 AND {self.inside(s)})" for s in self.slots}
        rows = self._rows().filter(" OR ".join(f"coalesce({hit}, false)" for hit in hits.values()))
        lists = self._aggregate([
            f"sort_array(collect_list(CASE WHEN {hit} THEN {s.value} END)) AS _list_{s.number}"
            for s, hit in hits.items()], rows)

        def at(s: _Slot, rank: str) -> str:
            upto, length = self.get("upto", s), self.get("inside", s)
            return (f"(CASE WHEN {rank} < {upto} THEN {self.get('lo', s)} "
                    f"WHEN {rank} < {upto} + {length} THEN get(_list_{s.number}, CAST({rank} - {upto} AS INT)) "
                    f"ELSE {self.get('hi', s)} END)")

        return self._results(lists, at)
