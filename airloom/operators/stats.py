"""Aggregates, profiles and the data behind each report."""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from airloom.functions.expr import aqi_category, clean_double, numeric_columns, round1, sample_std
from airloom.operators.attach import join_keys, with_literals
from airloom.operators.quantiles import approx_quantiles, exact_quantiles


# --- forecast summaries ---------------------------------------------------------------

def daily_summary(
    df: DataFrame, value: str = "predicted_aqi", *, keys: Sequence[str] = ("city",),
    order: str = "ts",
) -> DataFrame:
    """Per series and day: mean, min, max to one decimal, and the category of that mean."""
    days = df.groupBy(*keys, F.to_date(order).alias("day")).agg(
        round1(F.avg(value)).alias("avg_aqi"),
        round1(F.min(value)).alias("min_aqi"),
        round1(F.max(value)).alias("max_aqi"),
    )
    return days.withColumn("category", aqi_category("avg_aqi"))


def value_summary(
    df: DataFrame, value: str = "predicted_aqi", *, keys: Sequence[str] = (), order: str = "ts"
) -> DataFrame:
    """Row count, time range, and mean, min and max of one column."""
    return df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"),
        F.min(order).alias("first_ts"), F.max(order).alias("last_ts"),
        F.avg(value).alias("mean"), F.min(value).alias("min"), F.max(value).alias("max"),
    )


def category_counts(
    df: DataFrame, column: str = "aqi_category", *, keys: Sequence[str] = ()
) -> DataFrame:
    """Occurrences of each known value."""
    return df.filter(F.col(column).isNotNull()).groupBy(*keys, column).agg(
        F.count(F.lit(1)).alias("n")
    )


def category_share(
    df: DataFrame, column: str = "aqi_category", *, keys: Sequence[str] = ()
) -> DataFrame:
    """Occurrences and share of each value; the window runs over the counted rows only."""
    whole = W.partitionBy(*keys)
    return category_counts(df, column, keys=keys).withColumn(
        "share", F.col("n") / F.sum("n").over(whole)
    )


def headline_metrics(
    df: DataFrame, value: str = "predicted_aqi", category: str = "aqi_category", *,
    keys: Sequence[str] = (),
) -> DataFrame:
    """Mean, max, min and the most common category (smallest name on a tie).

    Grouped by category first, so that one very common category is counted map-side.
    """
    per_category = df.groupBy(*keys, category).agg(
        F.count(F.lit(1)).alias("_n"),
        F.sum(value).alias("_sum"), F.count(value).alias("_known"),
        F.max(value).alias("_max"), F.min(value).alias("_min"),
    )
    rank = F.when(F.col(category).isNotNull(), F.struct(-F.col("_n"), F.col(category)))
    return per_category.groupBy(*keys).agg(
        F.try_divide(F.sum("_sum"), F.sum("_known")).alias("avg_aqi"),
        F.max("_max").alias("max_aqi"), F.min("_min").alias("min_aqi"),
        F.min_by(category, rank).alias("most_common"),
    )


def recent_trend(
    df: DataFrame, value: str = "us_aqi", *, window: int = 168, recent: int = 24,
    keys: Sequence[str] = ("city",), order: str = "ts",
) -> DataFrame:
    """Statistics of the last ``window`` rows and whether the latest value is above the
    mean of the last ``recent`` rows."""
    back = F.row_number().over(W.partitionBy(*keys).orderBy(F.desc(order)))
    ranked = df.select(*keys, order, value).withColumn("_back", back).filter(F.col("_back") <= window)
    stats = ranked.groupBy(*keys).agg(
        F.avg(value).alias("mean"), sample_std(value).alias("std"),
        F.min(value).alias("min"), F.max(value).alias("max"),
        F.max_by(value, order).alias("latest"),
        F.avg(F.when(F.col("_back") <= recent, F.col(value))).alias("mean_recent"),
    )
    return stats.withColumn(
        "trend", F.when(F.col("latest") > F.col("mean_recent"), F.lit("UP")).otherwise(F.lit("DOWN"))
    )


# --- column profiles ------------------------------------------------------------------

def _unpivot(wide: DataFrame, names: Sequence[str], fields: dict[str, str], keys, label: str):
    """One row per profiled column out of columns called ``{field}:{name}``."""
    rows = F.array(*[
        F.struct(
            F.lit(n).alias(label),
            *[(F.col(f"`{f}:{n}`") if f"{f}:{n}" in wide.columns else F.lit(None))
              .cast(dtype).alias(f) for f, dtype in fields.items()],
        )
        for n in names
    ])
    return wide.select(*keys, F.inline(rows))


def _quantile_frame(df, columns, probs, keys, approx, beside: Sequence[Column] = ()) -> DataFrame:
    """Quantiles, and the other aggregates of the same first scan."""
    make = approx_quantiles if approx else exact_quantiles
    return make(df, columns, probs, keys=keys, beside=beside).withColumnsRenamed(
        {c: f"quantiles:{c}" for c in columns}
    )


def feature_profile(
    df: DataFrame, *, keys: Sequence[str] = (), order: str = "ts", approx: bool = False
) -> DataFrame:
    """Per column: row count, NULL count and, if numeric, mean, std, min, max and median."""
    names = [c for c in df.columns if c != order and c not in keys]
    numeric = [c for c in numeric_columns(df) if c in names]
    aggs: list[Column] = []
    for c in names:  # NaN is missing
        missing = (clean_double(c) if c in numeric else F.col(c)).isNull()
        aggs += [F.count(F.lit(1)).alias(f"count:{c}"), F.count_if(missing).alias(f"null_count:{c}")]
    for c in numeric:
        value = clean_double(c)
        aggs += [
            F.avg(value).alias(f"mean:{c}"), sample_std(value).alias(f"std:{c}"),
            F.min(value).alias(f"min:{c}"), F.max(value).alias(f"max:{c}"),
        ]
    if numeric:
        wide = _quantile_frame(df, numeric, [0.5], keys, approx, aggs).withColumns(
            {f"median:{c}": F.col(f"`quantiles:{c}`")[0] for c in numeric}
        )
    else:
        wide = df.groupBy(*keys).agg(*aggs)
    fields = {"count": "long", "null_count": "long", "mean": "double", "std": "double",
              "min": "double", "max": "double", "median": "double"}
    return _unpivot(wide, names, fields, keys, "feature_name")


def describe(
    df: DataFrame, columns: Sequence[str] | None = None, *, keys: Sequence[str] = (),
    approx: bool = False,
) -> DataFrame:
    """Per numeric column: count, mean, std, min, quartiles and max."""
    columns = list(columns or numeric_columns(df, exclude=tuple(keys)))
    aggs = []
    for c in columns:
        value = clean_double(c)
        aggs += [
            F.count(value).alias(f"count:{c}"), F.avg(value).alias(f"mean:{c}"),
            sample_std(value).alias(f"std:{c}"), F.min(value).alias(f"min:{c}"),
            F.max(value).alias(f"max:{c}"),
        ]
    wide = _quantile_frame(df, columns, [0.25, 0.5, 0.75], keys, approx, aggs).withColumns({
        f"{name}:{c}": F.col(f"`quantiles:{c}`")[i]
        for c in columns for i, name in enumerate(("q25", "q50", "q75"))
    })
    fields = {"count": "long", **dict.fromkeys(
        ("mean", "std", "min", "q25", "q50", "q75", "max"), "double")}
    return _unpivot(wide, columns, fields, keys, "column_name")


def missing_report(df: DataFrame) -> DataFrame:
    """Columns with missing values: their number and percentage, most missing first."""
    wide = df.agg(
        *[F.count_if(F.col(c).isNull()).alias(f"missing:{c}") for c in df.columns],
        F.count(F.lit(1)).alias("_rows"),
    ).withColumns({f"rows:{c}": F.col("_rows") for c in df.columns})
    long = _unpivot(wide, df.columns, {"missing": "long", "rows": "long"}, (), "column_name")
    return (
        long.filter("missing > 0")
        .select("column_name", "missing", (F.col("missing") / F.col("rows") * 100).alias("pct"))
        .orderBy(F.desc("missing"), "column_name")
    )


def aqi_stats(
    df: DataFrame, value: str = "us_aqi", *, order: str = "ts", approx: bool = False
) -> DataFrame:
    """Whole-table statistics of one column with the covered time range."""
    df = df.withColumn(value, clean_double(value))
    stats = [
        F.count(F.lit(1)).alias("n"), F.min(order).alias("first_ts"), F.max(order).alias("last_ts"),
        F.avg(value).alias("mean"), sample_std(value).alias("std"),
        F.min(value).alias("min"), F.max(value).alias("max"),
    ]
    return _quantile_frame(df, [value], [0.5], (), approx, stats).select(
        "n", "first_ts", "last_ts", "mean", F.col(f"`quantiles:{value}`")[0].alias("median"),
        "std", "min", "max",
    )


def median_of(df: DataFrame, columns: Sequence[str], *, keys: Sequence[str] = (),
              approx: bool = False) -> DataFrame:
    """Median of each column."""
    medians = _quantile_frame(df, columns, [0.5], keys, approx)
    return medians.select(*keys, *[F.col(f"`quantiles:{c}`")[0].alias(c) for c in columns])


def histogram(df: DataFrame, column: str, bins: int = 50) -> DataFrame:
    """Counts in ``bins`` equally wide intervals; the last one is closed. Empty bins are
    left out. The range takes one scan, the counts another."""
    value = clean_double(column)
    low, high = df.agg(F.min(value), F.max(value)).first()
    if low is None:
        return df.sparkSession.createDataFrame(
            [], "bin int, bin_low double, bin_high double, n long")
    width = (high - low) / bins
    place = (
        F.least(F.floor((value - low) / width), F.lit(bins - 1)) if width > 0 else F.lit(0)
    ).cast("int")
    return (
        df.filter(value.isNotNull())
        .groupBy(place.alias("bin"))
        .agg(F.count(F.lit(1)).alias("n"))
        .select("bin", (F.lit(low) + F.col("bin") * F.lit(width)).alias("bin_low"),
                (F.lit(low) + (F.col("bin") + 1) * F.lit(width)).alias("bin_high"), "n")
    )


def box_summary(df: DataFrame, columns: Sequence[str], *, approx: bool = False) -> DataFrame:
    """Quartiles, whiskers (the furthest values within 1.5 IQR) and outlier counts."""
    columns = list(columns)
    make = approx_quantiles if approx else exact_quantiles
    quartiles = make(df, columns, [0.25, 0.5, 0.75]).first()  # one row
    known = [c for c in columns if quartiles[c] is not None]
    aggs, limits = [], {}
    for c in known:
        q1, q2, q3 = quartiles[c]
        reach = 1.5 * (q3 - q1)
        value = F.col(c).cast("double")
        inside = value.between(q1 - reach, q3 + reach)
        limits[c] = (q1, q2, q3)
        aggs += [
            F.min(F.when(inside, value)).alias(f"whisker_low:{c}"),
            F.max(F.when(inside, value)).alias(f"whisker_high:{c}"),
            F.count_if(~inside).alias(f"outliers:{c}"),
        ]
    fields = {"q25": "double", "q50": "double", "q75": "double", "whisker_low": "double",
              "whisker_high": "double", "outliers": "long"}
    if not known:
        ddl = ", ".join(["column_name string", *[f"{k} {v}" for k, v in fields.items()]])
        return df.sparkSession.createDataFrame([], ddl)
    wide = df.agg(*aggs).withColumns({
        f"{name}:{c}": F.lit(limits[c][i])
        for c in known for i, name in enumerate(("q25", "q50", "q75"))
    })
    return _unpivot(wide, known, fields, (), "column_name")


# --- correlation ----------------------------------------------------------------------

def _correlation(a: str, b: str) -> Column:
    """Pearson correlation over the rows where both are known; NULL if either is constant."""
    x, y = F.col(a).cast("double"), F.col(b).cast("double")
    x_paired, y_paired = F.when(y.isNotNull(), x), F.when(x.isNotNull(), y)
    spread = sample_std(x_paired) * sample_std(y_paired)
    return F.try_divide(F.covar_samp(x, y), spread)


_MOMENTS = "i int, j int, n double, sx double, sy double, sxx double, syy double, sxy double"


def _pair_moments(shift: list[float]):
    """Per task, the pairwise-complete moments of all column pairs as masked products."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        width = len(shift)
        total = np.zeros((4, width, width))
        for batch in batches:
            # NULL arrives as NaN.
            x = np.column_stack([c.to_numpy(zero_copy_only=False) for c in batch.columns])
            x = x - np.array(shift)
            known = ~np.isnan(x)
            x[~known] = 0.0
            mask = known.astype("float64")
            total += np.stack([mask.T @ mask, x.T @ mask, (x * x).T @ mask, x.T @ x])
        n, sx, sxx, sxy = total
        i, j = np.triu_indices(width)
        yield pa.RecordBatch.from_pydict({
            "i": i.astype("int32"), "j": j.astype("int32"), "n": n[i, j], "sx": sx[i, j],
            "sy": sx[j, i], "sxx": sxx[i, j], "syy": sxx[j, i], "sxy": sxy[i, j],
        })

    return run


def _correlations(df: DataFrame, columns: list[str]) -> dict[tuple[str, str], float | None]:
    """Correlation of every column pair; the result is as small as the matrix itself.

    One pass finds constant columns and the means, a second one sums the moments around the
    means, one matrix product per batch. Pairs that are nearly constant on their common
    rows are settled by exact aggregates.
    """
    found: dict[tuple[str, str], float | None] = {}
    data = df.select(*[clean_double(c).alias(c) for c in columns])
    range_of = data.agg(*[
        a for i, c in enumerate(columns) for a in (
            F.min(c).alias(f"lo{i}"), F.max(c).alias(f"hi{i}"), F.avg(c).alias(f"mean{i}"))
    ]).first()
    varying = [c for i, c in enumerate(columns) if range_of[f"lo{i}"] != range_of[f"hi{i}"]]
    if not varying:
        return found
    shift = [range_of[f"mean{columns.index(c)}"] for c in varying]
    sums = (
        data.select(*varying).mapInArrow(_pair_moments(shift), _MOMENTS)
        .groupBy("i", "j").agg(*[F.sum(m).alias(m) for m in ("n", "sx", "sy", "sxx", "syy", "sxy")])
    )
    doubtful = []
    for m in sums.collect():  # one row per column pair
        pair = varying[m["i"]], varying[m["j"]]
        n = m["n"]
        vx, vy = n * m["sxx"] - m["sx"] ** 2, n * m["syy"] - m["sy"] ** 2
        if n < 2:
            continue
        if vx <= 1e-9 * n * m["sxx"] or vy <= 1e-9 * n * m["syy"]:
            doubtful.append(pair)
            continue
        r = (n * m["sxy"] - m["sx"] * m["sy"]) / math.sqrt(vx * vy)
        found[pair] = max(-1.0, min(1.0, r))
    if doubtful:
        exact = data.agg(*[_correlation(a, b).alias(f"r{i}") for i, (a, b) in enumerate(doubtful)]).first()
        found.update({pair: exact[f"r{i}"] for i, pair in enumerate(doubtful)})
    found.update({(b, a): r for (a, b), r in list(found.items())})
    return found


def corr_matrix(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """All pairwise correlations in long form (col_a, col_b, r), each pair in both orders.
    A constant column has none, not even with itself."""
    columns = list(columns or numeric_columns(df))
    found = _correlations(df, columns)
    rows = [(a, b, found.get((a, b))) for a in columns for b in columns]
    return df.sparkSession.createDataFrame(rows, "col_a string, col_b string, r double")


def corr_target(
    df: DataFrame, target: str = "us_aqi", columns: Sequence[str] | None = None
) -> DataFrame:
    """Correlation of every numeric column with the target, highest first."""
    columns = list(columns or numeric_columns(df))
    found = _correlations(df, list(dict.fromkeys([*columns, target])))
    rows = [(c, found.get((c, target))) for c in columns]
    return df.sparkSession.createDataFrame(rows, "column_name string, r double").orderBy(
        F.desc_nulls_last("r"), "column_name"
    )


# --- model quality --------------------------------------------------------------------

def regression_metrics(
    df: DataFrame, predicted: str = "predicted", actual: str = "actual", *,
    keys: Sequence[str] = (),
) -> DataFrame:
    """R2, MAE and RMSE over the rows where both values are known; R2 is NULL for a
    constant actual."""
    both = df.filter(F.col(predicted).isNotNull() & F.col(actual).isNotNull())
    error = F.col(predicted) - F.col(actual)
    varies = F.min(actual) != F.max(actual)
    return both.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"),
        F.when(varies, 1 - F.try_divide(
            F.sum(error * error), F.var_pop(actual) * F.count(actual))).alias("r2"),
        F.avg(F.abs(error)).alias("mae"),
        F.sqrt(F.avg(error * error)).alias("rmse"),
    )


# --- table level ----------------------------------------------------------------------

def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Row count of each named table."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("table_name"), "n")
        for name, df in tables.items()
    ]
    out = counts[0]
    for other in counts[1:]:
        out = out.unionByName(other)
    return out


def shape_report(df: DataFrame, *, order: str = "ts") -> DataFrame:
    """Row and column count, column names and covered time range."""
    return df.agg(
        F.count(F.lit(1)).alias("row_count"),
        F.min(order).alias("first_ts"), F.max(order).alias("last_ts"),
    ).select(
        "row_count", F.lit(len(df.columns)).cast("long").alias("column_count"),
        F.lit(", ".join(df.columns)).alias("column_names"), "first_ts", "last_ts",
    )


def melt_metrics(comparison: DataFrame, metric: str = "R2") -> DataFrame:
    """Train and test value of one metric as (Model, Dataset, value) rows."""
    pair = [f"{metric} (Train)", f"{metric} (Test)"]
    return comparison.unpivot("Model", [F.col(f"`{c}`") for c in pair], "Dataset", "value")
