"""Scalar expressions. Every function takes and returns Columns and stays inside codegen."""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from airloom.schemas import AQI_CATEGORIES, PM25_BREAKPOINTS, RUSH_HOURS

NUMERIC = (T.NumericType,)


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def numeric_columns(df: DataFrame, exclude: tuple[str, ...] = ()) -> list[str]:
    """Names of the numeric columns, in schema order."""
    return [
        f.name for f in df.schema if isinstance(f.dataType, NUMERIC) and f.name not in exclude
    ]


def clean_double(c: Column | str) -> Column:
    """Double with NaN folded into NULL, so that aggregates skip both alike."""
    return F.nanvl(_col(c).cast("double"), F.lit(None).cast("double"))


# --- time -----------------------------------------------------------------------------

def parse_time(c: Column | str) -> Column:
    """ISO text, with or without a trailing Z, to a UTC wall-clock time; bad text raises."""
    return F.to_timestamp_ntz(F.regexp_replace(_col(c), "Z$", ""))


def coerce_time(c: Column | str) -> Column:
    """As ``parse_time``, but bad text becomes NULL."""
    return F.try_to_timestamp(F.regexp_replace(_col(c), "Z$", "")).cast("timestamp_ntz")


def epoch_seconds(c: Column | str) -> Column:
    """Whole seconds since 1970 of a wall-clock time, without any time-zone conversion."""
    c = _col(c)
    return (
        F.unix_date(c.cast("date")).cast("long") * F.lit(86400).cast("long")
        + F.hour(c) * 3600 + F.minute(c) * 60 + F.second(c)
    )


def epoch_micros(c: Column | str) -> Column:
    """Microseconds since 1970 of a wall-clock time, without any time-zone conversion."""
    c = _col(c)
    whole = F.date_trunc("SECOND", c).cast("timestamp_ntz")
    fraction = F.extract(F.lit("SECOND"), c) - F.second(whole)
    return epoch_seconds(c) * 1_000_000 + (fraction * 1_000_000).cast("long")


def floor_hour(c: Column | str) -> Column:
    """Start of the hour."""
    return F.date_trunc("HOUR", _col(c)).cast("timestamp_ntz")


def hour_label(c: Column | str) -> Column:
    """Hour as display text."""
    return F.date_format(_col(c), "yyyy-MM-dd HH:00")


def calendar(c: Column | str = "ts") -> dict[str, Column]:
    """Calendar features; weeks start on Monday = 0."""
    c = _col(c)
    return {
        "hour": F.hour(c),
        "day": F.dayofmonth(c),
        "month": F.month(c),
        "day_of_week": F.weekday(c),
        "is_weekend": (F.weekday(c) >= 5).cast("int"),
        "is_rush_hour": F.hour(c).isin(*RUSH_HOURS).cast("int"),
    }


def interactions(columns: list[str]) -> dict[str, Column]:
    """Products of weather columns, each only where both inputs exist."""
    pairs = {
        "temp_humidity_interaction": ("temp", "humidity"),
        "wind_pressure_interaction": ("wind_speed", "pressure"),
    }
    return {
        name: F.col(a) * F.col(b)
        for name, (a, b) in pairs.items() if a in columns and b in columns
    }


# --- air-quality index ----------------------------------------------------------------

def pm25_to_aqi(c: Column | str) -> Column:
    """Piecewise linear index; NULL in the gaps between intervals and outside of them."""
    c = _col(c)
    branches = [
        (c.between(c_low, c_high),
         F.lit(float(i_high - i_low)) / F.lit(c_high - c_low) * (c - c_low) + float(i_low))
        for c_low, c_high, i_low, i_high in PM25_BREAKPOINTS
    ]
    first, rest = branches[0], branches[1:]
    return reduce(lambda acc, b: acc.when(*b), rest, F.when(*first))


def fill_us_aqi(us_aqi: Column | str = "us_aqi", pm25: Column | str = "pm2_5") -> Column:
    """The given index, or the one derived from PM2.5 where it is missing."""
    return F.coalesce(_col(us_aqi), pm25_to_aqi(pm25))


def _by_category(c: Column, field: int) -> Column:
    closed = [row for row in AQI_CATEGORIES if row[0] is not None]
    expr = F.when(c.isNull() | F.isnan(c), F.lit(None).cast("string"))
    for row in closed:
        expr = expr.when(c <= row[0], F.lit(row[field]))
    return expr.otherwise(F.lit(AQI_CATEGORIES[-1][field]))


def aqi_category(c: Column | str) -> Column:
    """Health category of an index value; a missing value has none."""
    return _by_category(_col(c).cast("double"), 1)


def aqi_color(c: Column | str) -> Column:
    """Chart colour of an index value."""
    return _by_category(_col(c).cast("double"), 2)


# --- errors and model quality ---------------------------------------------------------

def abs_error(predicted: Column | str, actual: Column | str) -> Column:
    return F.abs(_col(predicted) - _col(actual))


def error_pct(predicted: Column | str, actual: Column | str) -> Column:
    """Absolute error in percent of the actual value; 0 unless the actual is positive."""
    actual = _col(actual)
    return F.when(actual > 0, abs_error(predicted, actual) / actual * 100).otherwise(0.0)


def metric(name: str, metrics: Column | str = "metrics") -> Column:
    """One entry of a metrics map, 0 when absent or undefined."""
    return F.coalesce(clean_double(F.try_element_at(_col(metrics), F.lit(name))), F.lit(0.0))


def model_status(r2_test: Column | str) -> Column:
    return F.when(_col(r2_test) > 0.7, F.lit("Good")).otherwise(F.lit("Needs improvement"))


def round1(c: Column | str) -> Column:
    """One decimal, ties to even."""
    return F.bround(_col(c), 1)


# --- aggregates -----------------------------------------------------------------------

def sample_std(c: Column | str) -> Column:
    """Sample standard deviation that is exactly 0 for a constant column.

    Merging partial variances rounds, which would leave a constant with a tiny spread.
    """
    c = _col(c)
    constant = (F.min(c) == F.max(c)) & (F.count(c) > 1)
    return F.when(constant, F.lit(0.0)).otherwise(F.stddev_samp(c))


# --- row filters ----------------------------------------------------------------------

def drop_missing(df: DataFrame, *columns: str) -> DataFrame:
    """Rows in which every named column (by default every column) is present."""
    return df.na.drop("any", subset=list(columns) or None)


def drop_sparse(df: DataFrame, share: float = 0.5) -> DataFrame:
    """Rows in which at least ``share`` of all columns are present."""
    return df.na.drop(thresh=math.ceil(len(df.columns) * share))


def not_before(df: DataFrame, now: Column, order: str = "ts") -> DataFrame:
    """Rows at or after an instant passed in as a column or literal."""
    return df.filter(F.col(order) >= now)


def on_day(df: DataFrame, now: Column, order: str = "ts") -> DataFrame:
    """Rows of the calendar day of ``now``, as a range so that file statistics can prune."""
    start = F.date_trunc("DAY", now).cast("timestamp_ntz")
    return df.filter((F.col(order) >= start) & (F.col(order) < start + F.expr("INTERVAL 1 DAY")))


def trailing_days(df: DataFrame, today: Column, days: int = 30, order: str = "ts") -> DataFrame:
    """Rows of the ``days`` full days that end the day before ``today``."""
    end = F.to_date(today)
    return df.filter(
        (F.col(order) >= F.date_sub(end, days).cast("timestamp_ntz"))
        & (F.col(order) < end.cast("timestamp_ntz"))
    )
