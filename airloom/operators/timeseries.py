"""Window and time-series operators over series keyed by city and ordered by time."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from airloom.functions.expr import numeric_columns
from airloom.operators.attach import join_keys
from airloom.operators.quantiles import exact_quantiles
from airloom.operators.series import (
    BLOCK_ROWS, fill, mean_over_time, over_rows, over_time, rank_cuts, with_position,
)
from airloom.schemas import AQI_LAGS
from airloom.session import materialize


def forward_fill(df: DataFrame, columns: Sequence[str] | None = None, **series) -> DataFrame:
    """Last known value of the series; by default for every numeric column."""
    return fill(df, columns or numeric_columns(df), "forward", **series)


def backward_fill(df: DataFrame, columns: Sequence[str] | None = None, **series) -> DataFrame:
    """Next known value of the series; by default for every numeric column."""
    return fill(df, columns or numeric_columns(df), "backward", **series)


def fill_then_median(
    df: DataFrame, columns: Sequence[str] | None = None, *, approx: bool = False, **series
) -> DataFrame:
    """Forward, then backward, then the median over all series.

    The median is needed only for a column that some series lacks altogether; nothing is
    computed for it unless such a column exists.
    """
    columns = list(columns or numeric_columns(df))
    filled = materialize(fill(df, columns, "both", **series))
    open_cells = filled.agg(
        *[F.coalesce(F.bool_or(F.col(c).isNull()), F.lit(False)).alias(c) for c in columns]
    ).first()
    lacking = [c for c in columns if open_cells[c]]
    if not lacking:
        return filled
    if approx:
        medians = filled.agg(*[F.percentile_approx(c, 0.5).alias(c) for c in lacking]).first()
        found = {c: medians[c] for c in lacking}
    else:
        quantiles = exact_quantiles(filled, lacking, [0.5], keys=()).first()
        found = {c: quantiles[c][0] for c in lacking if quantiles[c] is not None}
    found = {c: v for c, v in found.items() if v is not None}
    return filled.na.fill(found) if found else filled


def fill_then_zero(
    df: DataFrame, columns: Sequence[str] | None = None, **series
) -> DataFrame:
    """Forward, then backward, then 0: the scoring-time fill."""
    columns = list(columns or numeric_columns(df))
    return fill(df, columns, "both", **series).na.fill(0.0, subset=columns)


def rolling_mean(
    df: DataFrame,
    columns: Sequence[str],
    window: int = 3,
    *,
    by: str = "rows",
    suffix: str = "_rolling_3h",
    **series,
) -> DataFrame:
    """Trailing mean of the known values among the last ``window`` rows, or hours."""
    if by == "rows":
        return over_rows(
            df, lambda w: {f"{c}{suffix}": F.avg(c).over(w.rowsBetween(1 - window, 0)) for c in columns}, window - 1, **series)
    if by == "time":
        return mean_over_time(df, {f"{c}{suffix}": c for c in columns}, (window - 1) * 3600, **series)
    raise ValueError(f"unknown frame {by!r}")


def add_lags(
    df: DataFrame,
    target: str = "us_aqi",
    lags: Sequence[int] = AQI_LAGS,
    *,
    by: str = "rows",
    keys: Sequence[str] = ("city",),
    order: str = "ts",
    prefix: str = "aqi_lag_",
    block_rows: int = BLOCK_ROWS,
    bucket_seconds: int | None = None,
    split: bool | DataFrame | None = None,
) -> DataFrame:
    """Earlier values of ``target``: k rows ago, or exactly k hours ago."""
    if by == "rows":
        return over_rows(
            df, lambda w: {f"{prefix}{k}": F.lag(target, k).over(w) for k in lags}, max(lags),
            keys=keys, order=order, block_rows=block_rows, bucket_seconds=bucket_seconds,
            split=split,
        )
    if by != "time":
        raise ValueError(f"unknown lag unit {by!r}")
    def back(k: int) -> int:
        return -k * 3600 * 1_000_000

    # One frame per lag that holds exactly the instant looked back at: a single shuffle.
    return over_time(
        df, lambda w: {
            f"{prefix}{k}": F.when(
                F.col(order).isNotNull(), F.max(target).over(w.rangeBetween(back(k), back(k))))
            for k in lags
        }, max(lags) * 3600, keys=keys, order=order, bucket_seconds=bucket_seconds, split=split,
    )


def sequence_windows(
    df: DataFrame, features: Sequence[str], target: str, steps: int = 24, **series
) -> DataFrame:
    """The ``steps`` preceding rows of features as an array, beside the row's own target."""
    def build(w):
        frame = w.rowsBetween(-steps, -1)
        return {"sequence": F.collect_list(F.struct(*features)).over(frame)}

    out = over_rows(df, build, steps, **series)
    keys, order = series.get("keys", ("city",)), series.get("order", "ts")
    return out.filter(F.size("sequence") == steps).select(
        *keys, order, "sequence", F.col(target).alias("target")
    )


def chrono_marks(
    df: DataFrame, shares: dict[str, float], *, keys: Sequence[str] = ("city",),
    order: str = "ts", bucket_seconds: int | None = None, split: bool | DataFrame | None = None,
) -> DataFrame:
    """Per named share, flag the first ``int(n * share)`` rows of each series.

    Ranks are found on the key columns alone; the rows themselves are not shuffled when the
    cut table (one row per series) is small enough for the planner to broadcast.
    """
    cuts = rank_cuts(
        df, lambda n: {f"_cut_{name}": F.floor(n * F.lit(share)) for name, share in shares.items()},
        keys=keys, order=order, bucket_seconds=bucket_seconds, split=split,
    )
    # Without a cut (a share of 1) every row comes before it; rows without a time come first.
    before = {
        name: F.coalesce(F.col(order) < F.col(f"_cut_{name}"), F.lit(share > 0)) for name, share in shares.items()
    }
    return join_keys(df, cuts, keys, "left").select(*df.columns, *[b.alias(n) for n, b in before.items()])


def chrono_split(
    df: DataFrame, train_share: float = 0.8, *, name: str = "is_train", **series
) -> DataFrame:
    """Flag the first ``int(n * train_share)`` rows of each series as training rows."""
    return chrono_marks(df, {name: train_share}, **series)


def cv_folds(
    df: DataFrame, splits: int = 5, *, keys: Sequence[str] = ("city",), order: str = "ts",
    name: str = "fold", bucket_seconds: int | None = None, split: bool | DataFrame | None = None,
) -> DataFrame:
    """Expanding-window cross-validation: fold k tests on its rows and trains on lower folds.

    Each test fold holds ``n // (splits + 1)`` rows and the last one ends the series; fold 0
    holds the remainder and is only trained on.
    """
    def ranks(n: Column) -> dict[str, Column]:
        size = F.floor(n / F.lit(splits + 1))
        return {
            f"_cut{k}": F.when(size > 0, n - size * (splits + 1 - k))
            for k in range(1, splits + 1)
        }

    cuts = rank_cuts(
        df, ranks, keys=keys, order=order, bucket_seconds=bucket_seconds, split=split
    )
    past = [
        F.coalesce((F.col(order) >= F.col(f"_cut{k}")).cast("int"), F.lit(0))
        for k in range(1, splits + 1)
    ]
    # One row per series: the planner broadcasts it by measured size, and a hot series is
    # split by the adaptive skew join otherwise.
    return join_keys(df, cuts, keys, "left").select(*df.columns, sum(past[1:], past[0]).alias(name))


def latest(
    df: DataFrame, columns: Sequence[str], *, keys: Sequence[str] = ("city",), order: str = "ts"
) -> DataFrame:
    """Values of the most recent row of each series."""
    return df.groupBy(*keys).agg(
        F.max(order).alias(order), *[F.max_by(c, order).alias(c) for c in columns]
    )


def last_rows(
    df: DataFrame, n: int, *, keys: Sequence[str] = ("city",), order: str = "ts",
    ties: Sequence[str] = (),
) -> DataFrame:
    """The last ``n`` rows of each series; map tasks keep at most n rows per series. ``ties``
    order rows of one time, ascending."""
    return _limit_rows(df, n, keys, F.desc(order), *ties)


def first_rows(
    df: DataFrame, n: int, *, keys: Sequence[str] = ("city",), order: str = "ts",
    ties: Sequence[str] = (),
) -> DataFrame:
    """The first ``n`` rows of each series; map tasks keep at most n rows per series."""
    return _limit_rows(df, n, keys, F.asc(order), *ties)


def _limit_rows(df: DataFrame, n: int, keys: Sequence[str], *order: Column | str) -> DataFrame:
    if not keys:
        return df.orderBy(*order).limit(n)
    window = W.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(window)).filter(F.col("_rank") <= n).drop(
        "_rank"
    )


__all__ = [
    "add_lags", "backward_fill", "chrono_marks", "chrono_split", "cv_folds", "fill_then_median",
    "fill_then_zero", "first_rows", "forward_fill", "last_rows", "latest", "rolling_mean",
    "sequence_windows", "with_position",
]
