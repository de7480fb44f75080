"""Feature matrices for training and scoring."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from airloom.functions.expr import calendar, interactions, not_before, numeric_columns
from airloom.operators.joins import last_known
from airloom.operators.timeseries import fill_then_zero, first_rows, rolling_mean
from airloom.schemas import AQI_LAGS, NON_FEATURES, SOURCE_FORECAST


def feature_columns(df: DataFrame, target: str = "us_aqi") -> list[str]:
    """Numeric columns that may serve as features, in schema order."""
    return numeric_columns(df, exclude=(*NON_FEATURES, target))


def align_features(
    df: DataFrame, names: Sequence[str], *, keep: Sequence[str] = ("city", "ts")
) -> DataFrame:
    """Exactly the named features, in that order; absent or missing values become 0."""
    present = set(df.columns)
    return df.select(
        *keep,
        *[
            (F.coalesce(F.col(c).cast("double"), F.lit(0.0)) if c in present else F.lit(0.0)).alias(c)
            for c in names
        ],
    )


def augment(df: DataFrame, *, order: str = "ts", **series) -> DataFrame:
    """Add calendar and interaction features and the trailing means of PM2.5 and temperature."""
    with_scalars = df.withColumns({**calendar(order), **interactions(df.columns)})
    rolled = [c for c in ("pm2_5", "temp") if c in df.columns]
    return rolling_mean(with_scalars, rolled, order=order, **series) if rolled else with_scalars


def forecast_weather(
    raw_weather: DataFrame, now: Column, *, hours: int = 144, keys: Sequence[str] = ("city",),
    order: str = "ts",
) -> DataFrame:
    """The next ``hours`` forecast rows of each series from ``now`` on."""
    ahead = not_before(raw_weather.filter(F.col("source") == SOURCE_FORECAST), now, order)
    return first_rows(ahead, hours, keys=keys, order=order)


def forecast_features(
    forecast: DataFrame, raw_aqi: DataFrame, *, default_aqi: float = 50.0,
    keys: Sequence[str] = ("city",), order: str = "ts", **series,
) -> DataFrame:
    """Scoring-time features: as in training, except that all lags hold the last known
    index and the PM2.5 mean is 0, since neither is known ahead."""
    scalars = forecast.withColumns({
        **calendar(order), **interactions(forecast.columns), "pm2_5_rolling_3h": F.lit(0.0),
    })
    rolled = rolling_mean(scalars, ["temp"], keys=keys, order=order, **series)
    lagged = last_known(
        rolled, raw_aqi, default=default_aqi, names=[f"aqi_lag_{k}" for k in AQI_LAGS],
        keys=keys, order=order,
    )
    gaps = [
        c for c in ("temp", "humidity", "pressure", "wind_speed", "clouds", "lat", "lon",
                    "temp_humidity_interaction", "wind_pressure_interaction", "temp_rolling_3h")
        if c in lagged.columns
    ]
    return fill_then_zero(lagged, gaps, keys=keys, order=order, **series)
