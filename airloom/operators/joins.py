"""Joins between readings, dimension tables and probes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from airloom.functions.expr import aqi_category
from airloom.operators.attach import join_keys
from airloom.operators.series import BLOCK_ROWS, bucketed, must_split
from airloom.schemas import breakpoint_dim, category_dim
from airloom.session import materialize


def merge_readings(
    weather: DataFrame, aqi: DataFrame, *, keys: Sequence[str] = ("city", "ts"),
    suffixes: tuple[str, str] = ("_weather", "_aqi"),
) -> DataFrame:
    """Inner join of both feeds; columns present on both sides get a suffix."""
    shared = (set(weather.columns) & set(aqi.columns)) - set(keys)

    def renamed(df: DataFrame, suffix: str) -> DataFrame:
        return df.withColumnsRenamed({c: c + suffix for c in shared})

    return renamed(weather, suffixes[0]).join(renamed(aqi, suffixes[1]), list(keys))


def restrict_to(df: DataFrame, other: DataFrame, on: Sequence[str] = ("city", "ts")) -> DataFrame:
    """Rows whose key occurs in ``other``."""
    return df.join(other.select(*on), list(on), "left_semi")


def pair_by_key(
    predicted: DataFrame, actual: DataFrame, on: Sequence[str] = ("city", "ts")
) -> DataFrame:
    """Predictions beside the actual values of the same key."""
    return predicted.join(actual, list(on))


def pm25_range_join(df: DataFrame, value: str = "pm2_5", name: str = "aqi_from_pm25") -> DataFrame:
    """Index from PM2.5 by joining the breakpoint intervals (a fixed seven-row table)."""
    dim = F.broadcast(breakpoint_dim(df.sparkSession))
    slope = (F.col("i_high") - F.col("i_low")) / (F.col("c_high") - F.col("c_low"))
    return df.join(
        dim, F.col(value).between(F.col("c_low"), F.col("c_high")), "left"
    ).select(*df.columns, (slope * (F.col(value) - F.col("c_low")) + F.col("i_low")).alias(name))


def category_join(df: DataFrame, value: str) -> DataFrame:
    """Add category, colour, zone and advice from the fixed six-row category table."""
    dim = F.broadcast(category_dim(df.sparkSession))
    inside = (F.col(value) > F.col("low")) & (F.col(value) <= F.col("high"))
    return df.join(dim, inside, "left").drop("low", "high")


def last_known(
    df: DataFrame, readings: DataFrame, value: str = "us_aqi", *, default: float = 50.0,
    names: Sequence[str], keys: Sequence[str] = ("city",), order: str = "ts",
) -> DataFrame:
    """Copy each series' most recent ``value`` into all of ``names``; ``default`` if unknown.

    One row per series is joined: broadcast by measured size, else an adaptive skew join. Series without a
    key are one series, on either side.
    """
    recent = readings.groupBy(*keys).agg(F.max_by(value, order).alias("_recent"))
    known = F.coalesce(F.col("_recent"), F.lit(default))
    return join_keys(df, recent, keys, "left").select(
        *[c for c in df.columns if c not in names], *[known.alias(n) for n in names]
    )


def nearest_reading(
    df: DataFrame, instant: Column, *, keys: Sequence[str] = ("city",), order: str = "ts"
) -> DataFrame:
    """Per series, the row closest to one instant; the earlier row wins a tie."""
    distance = F.abs(F.timestamp_diff("MICROSECOND", instant, F.col(order)))
    others = [c for c in df.columns if c not in keys]
    return (
        df.groupBy(*keys)
        .agg(F.min_by(F.struct(*others), F.struct(distance, F.col(order))).alias("_row"))
        .select(*keys, "_row.*")
    )


def nearest_join(
    probes: DataFrame,
    readings: DataFrame,
    *,
    keys: Sequence[str] = ("city",),
    order: str = "ts",
    prefix: str = "near_",
    tolerance_seconds: int | None = None,
    bucket_seconds: int | None = None,
    split: bool | DataFrame | None = None,
) -> DataFrame:
    """Beside each probe, the reading of its series closest in time (earlier one on a tie).

    Probes and readings are merged into one timeline, along which the last and the next reading are carried with
    their values, so every row is shuffled once and no join follows. If some timeline is too long for one task it is cut
    into buckets of time, and each bucket receives the reading before and after it. A bucket with very many
    probes, at whatever instants, is dealt to several tasks that all receive its readings; this costs a second shuffle.

    Series without a key are series of their own. Probes without a time or a reading (within the tolerance) get NULLs;
    a reading needs a time, and (keys, time) identify it.
    """
    values = [c for c in readings.columns if c not in (*keys, order)]
    probe_type, reading = probes.schema, F.struct(F.col(order), *values)
    told = readings.filter(F.col(order).isNotNull()).select(*keys, order, reading.alias("_reading"))
    timeline = probes.select(*keys, order, F.struct(*probes.columns).alias("_probe")).unionByName(
        told, allowMissingColumns=True)
    # A frame of lengths counts the readings; there may be more probes than that.
    count = probes.select(*keys).unionByName(readings.select(*keys))
    if isinstance(split, DataFrame):
        count = probes.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows")).unionByName(split.select(*keys, "rows"))
        cut = must_split(probes, keys, count)
    else:
        cut = must_split(count, keys, split)
    if cut:
        rows = bucketed(timeline, keys, order, bucket_seconds)
        around = materialize(_readings_around(rows, keys, order))
        rows = join_keys(rows, around, [*keys, "_bucket"])
        dealt = F.monotonically_increasing_id() % F.col("_shares")
        if around.filter("_shares > 1").isEmpty():
            shares = F.lit(0).cast("long")
        else:
            shares = F.explode(F.when(F.col("_probe").isNotNull(), F.array(dealt)).otherwise(F.sequence(
                F.lit(0).cast("long"), F.col("_shares") - 1)))
        rows = rows.withColumn("_share", shares)
        span = W.partitionBy(*keys, "_bucket", "_share")
        outside = {"_prev": [F.col("_before")], "_next": [F.col("_after")]}
    else:
        rows, span, outside = timeline, W.partitionBy(*keys), {"_prev": [], "_next": []}
    # Frames by time: a reading at the probe's own instant counts in either direction.
    up_to = span.orderBy(order).rangeBetween(W.unboundedPreceding, 0)
    from_on = span.orderBy(F.desc(order)).rangeBetween(W.unboundedPreceding, 0)
    found = rows.select(
        "_probe",
        F.coalesce(F.last("_reading", ignorenulls=True).over(up_to), *outside["_prev"]).alias("_prev"),
        F.coalesce(F.last("_reading", ignorenulls=True).over(from_on), *outside["_next"]).alias("_next"),
    ).filter(F.col("_probe").isNotNull())
    at = F.col(f"_probe.{order}")
    since = F.timestamp_diff("MICROSECOND", F.col(f"_prev.{order}"), at)
    until = F.timestamp_diff("MICROSECOND", at, F.col(f"_next.{order}"))
    nearest = F.when(F.col("_next").isNull() | (since <= until), F.col("_prev")).otherwise(F.col("_next"))
    near = F.when(at.isNotNull(), nearest)
    if tolerance_seconds is not None:
        near = F.when(F.least(since, until) <= tolerance_seconds * 1_000_000, near)
    return found.withColumn("_near", near).select(
        *[F.col(f"_probe.{f.name}") for f in probe_type], F.col(f"_near.{order}").alias(f"{prefix}{order}"),
        *[F.col(f"_near.{c}").alias(f"{prefix}{c}") for c in values]
    )


def _readings_around(timeline: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    """Per bucket, the last reading before it, the first one after it, and how many tasks share its probes."""
    series = W.partitionBy(*keys)
    earlier = series.orderBy("_bucket").rowsBetween(W.unboundedPreceding, -1)
    later = series.orderBy(F.desc("_bucket")).rowsBetween(W.unboundedPreceding, -1)
    known = F.when(F.col("_reading").isNotNull(), F.col(order))
    per_bucket = timeline.groupBy(*keys, "_bucket").agg(
        F.max_by("_reading", known).alias("_last"), F.min_by("_reading", known).alias("_first"), F.count("_probe").alias("_probes"))
    return per_bucket.select(
        *keys, "_bucket", F.last("_last", ignorenulls=True).over(earlier).alias("_before"),
        F.last("_first", ignorenulls=True).over(later).alias("_after"),
        (F.floor(F.col("_probes") / BLOCK_ROWS) + 1).alias("_shares"),
    )


def with_category(df: DataFrame, value: str, name: str = "aqi_category") -> DataFrame:
    """Category by expression: cheaper than ``category_join`` when no other field is needed."""
    return df.withColumn(name, aqi_category(value))
