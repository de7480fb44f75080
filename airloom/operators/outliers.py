"""Sequential z-score outlier filter."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airloom.operators.attach import attach
from airloom.schemas import OUTLIER_COLUMNS
from airloom.session import materialize


def zscore_filter(
    df: DataFrame,
    columns: Sequence[str] = OUTLIER_COLUMNS,
    threshold: float = 3.0,
    *,
    keys: Sequence[str] = ("city",),
    min_rows: int = 50,
    min_keep: float = 0.8,
    stored: bool = False,
) -> DataFrame:
    """Screen the columns one after another, each on the rows the ones before it left.

    A row stays while ``|x - mean| / std < threshold``; a missing x fails. A column is
    skipped when its std is 0 or unknown or when fewer than ``min_keep`` of the remaining
    rows would stay, and a group under ``min_rows`` rows is left alone.

    One aggregation per column decides whether the column applies and, at the same time,
    computes the next column's statistics for either outcome. The decisions are one small
    stored row per group, so the plan stays flat however many columns there are. Pass
    ``stored=True`` if ``df`` already reads a stored table; otherwise it is stored first.
    """
    columns = [c for c in columns if c in df.columns]
    if not columns:
        return df
    base = df if stored else materialize(df)
    slim = base.select(*dict.fromkeys([*keys, *columns]))

    def fits(i: int) -> str:
        z = f"abs((`{columns[i]}` - _mean{i}) / _std{i})"
        return f"coalesce(_usable{i} AND {z} < {float(threshold)!r}D, false)"

    def kept(count: int) -> str:
        return " AND ".join(["true", *[f"(NOT _apply{i} OR {fits(i)})" for i in range(count)]])

    def judged(i: int, mean: str, spread: str) -> list[str]:
        """State of column i: statistics, and whether they can be used. An unusable std
        becomes NULL, which keeps the division by it defined."""
        usable = f"coalesce(_rows >= {min_rows} AND {spread} <> 0 AND NOT isnan({spread}), false)"
        return [f"{mean} AS _mean{i}", f"if({usable}, {spread}, NULL) AS _std{i}", f"{usable} AS _usable{i}"]

    def std(value: str) -> str:
        return f"if(min({value}) = max({value}), 0D, stddev_samp({value}))"

    first = f"`{columns[0]}`"
    state = materialize(
        slim.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("_rows"), F.expr(f"avg({first}) AS _m"),
             F.expr(f"{std(first)} AS _s"))
        .selectExpr(*keys, "_rows", *judged(0, "_m", "_s"))
    )
    groups = state.count() if keys else 1
    for i in range(len(columns)):
        carried = [c for c in state.columns if c not in keys]
        aggs = ["count(1) AS _seen", f"count_if({fits(i)}) AS _fit"]
        if i + 1 < len(columns):
            following = f"`{columns[i + 1]}`"
            cut = f"CASE WHEN {fits(i)} THEN {following} END"
            aggs += [
                f"avg({following}) AS _mean_skip", f"{std(following)} AS _std_skip",
                f"avg({cut}) AS _mean_cut", f"{std(cut)} AS _std_cut",
            ]
        rows = attach(slim, state, keys, salt_on=columns, table_rows=groups).filter(kept(i))
        counted = rows.groupBy(*keys).agg(*[F.expr(a) for a in aggs])
        # The decision needs the group's earlier state: one more row-per-group join.
        decided = attach(counted, state, keys, salt_on=keys, table_rows=groups).selectExpr(
            "*", f"_usable{i} AND _fit / _seen >= {float(min_keep)!r}D AS _apply{i}"
        )
        step = [*keys, *carried, f"_apply{i}"]
        if i + 1 < len(columns):
            step += judged(i + 1, f"if(_apply{i}, _mean_cut, _mean_skip)",
                           f"if(_apply{i}, _std_cut, _std_skip)")
        state = materialize(decided.selectExpr(*step))
    screened = attach(base, state, keys, salt_on=columns, table_rows=groups)
    return screened.filter(kept(len(columns))).select(*df.columns)
