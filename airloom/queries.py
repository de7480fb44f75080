"""Registered queries: each operator run over whole input tables of a data folder."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from airloom import fixtures as fx
from airloom import schemas
from airloom.functions import expr
from airloom.ml import features as mlf
from airloom.ml import boosting, scoring, training
from airloom.operators import joins, outliers, stats
from airloom.operators import timeseries as tsop
from airloom.operators.quantiles import exact_quantiles
from airloom.operators.series import global_rank
from airloom.plans import pipelines, reports
from airloom.report_cells import ANALYSED, PAGES
from airloom.session import materialize, scratch_dir
from airloom.sources import feeds, metadata, registry
from airloom.sources.metadata import FeatureStore
from airloom.sources.tables import Table, Warehouse, merge_columns, preprocessed_or_joined
from airloom.streaming import ingest as streaming

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}



def now():
    return fx.at(fx.NOW)


ALL_MEASURES = [*schemas.WEATHER_MEASURES, *schemas.AQI_MEASURES]
# Features asked for in registry order; `lat_weather` is absent from the forecast.
ALIGNED = ["wind_speed", "lat_weather", "temp", "humidity", "clouds", "temp_rolling_3h"]


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def joined(spark: SparkSession, d: str) -> DataFrame:
    return joins.merge_readings(fx.raw_weather(spark, d), fx.raw_aqi(spark, d))


def predictions(spark: SparkSession, d: str) -> DataFrame:
    return joins.with_category(fx.aqi_predictions(spark, d), "predicted_aqi")


def daily(spark: SparkSession, d: str, *columns: str) -> DataFrame:
    """The many-series table, stored because the operators on it scan it several times."""
    rows = fx.readings_scale(spark, d)
    return materialize(rows.select(*columns) if columns else rows)


def rounded(df: DataFrame, *columns: str, digits: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in columns})


def _work_path(spark: SparkSession, name: str) -> str:
    return f"{scratch_dir(spark)}/{name}-{uuid.uuid4().hex}"


# --- sources --------------------------------------------------------------------------

def _daily_payloads(hours: DataFrame, fields: dict[str, str], cut: dict[str, int], absent: str) -> DataFrame:
    """One JSON payload per city and day, built from hourly rows: the arrays in ``cut`` are
    short, ``absent`` is missing on even days, and odd hours carry a Z suffix."""
    stamp = F.concat(
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm"),
        F.when(F.hour("ts") % 2 == 1, F.lit("Z")).otherwise(F.lit("")),
    )
    one_day = F.sort_array(F.collect_list(F.struct("ts", stamp.alias("stamp"), *fields.values())))
    days = hours.groupBy("city", F.to_date("ts").alias("day")).agg(one_day.alias("h"))  # at most 24 rows

    def values(wire: str, name: str):
        if wire in cut:
            return F.slice(f"h.{name}", 1, cut[wire])
        if wire == absent:
            return F.when(F.dayofmonth("day") % 2 == 1, F.col(f"h.{name}"))
        return F.col(f"h.{name}")

    hourly = F.struct(F.col("h.stamp").alias("time"), *[values(w, n).alias(w) for w, n in fields.items()])
    return days.select("city", F.to_json(F.struct(
        F.lit(27.7).alias("latitude"), hourly.alias("hourly"))).alias("payload"))


_WEATHER_GAPS = {"cut": {"relative_humidity_2m": 12}, "absent": "cloud_cover"}
_AQI_GAPS = {"cut": {"pm10": 5, "ozone": 20}, "absent": "us_aqi"}


@query
def columnar_json(spark, d):
    """Payloads held as text in a column."""
    texts = _daily_payloads(fx.weather_hourly(spark, d), schemas.WEATHER_FIELDS, **_WEATHER_GAPS)
    return feeds.decode_text(texts, "payload", schemas.WEATHER_FIELDS)


def _landed(spark, payloads: DataFrame) -> str:
    path = _work_path(spark, "landed")
    payloads.write.partitionBy("city").text(path)
    return path


@query
def weather_files(spark, d):
    """Landed weather payload files, one folder per city."""
    hours = fx.weather_hourly(spark, d)
    path = _landed(spark, _daily_payloads(hours, schemas.WEATHER_FIELDS, **_WEATHER_GAPS))
    read = feeds.read_weather_forecast(spark, path, F.col("city"), lon=68.9, multiline=False)
    return read.drop("fetched_at")


@query
def aqi_files(spark, d):
    """Landed pollutant payload files, one folder per city."""
    path = _landed(spark, _daily_payloads(fx.raw_aqi(spark, d), schemas.AQI_FIELDS, **_AQI_GAPS))
    read = feeds.read_aqi(spark, path, F.col("city"), lat=27.7, lon=68.9, multiline=False)
    return read.drop("fetched_at")


@query
def time_coercion(spark, d):
    """Event times as text, every seventh one broken."""
    text = F.when(F.col("event_id") % 7 == 0, F.lit("not a time")).otherwise(
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'"))
    events = spark.read.parquet(f"{d}/events.parquet")
    return events.select("event_id", expr.coerce_time(text).alias("ts"))


@query
def weather_upsert(spark, d):
    return fx.raw_weather(spark, d)


@query
def feed_ingest(spark, d):
    """Both feeds upserted into stored monthly tables, the forecast over the archive."""
    log = materialize(fx.weather_feed(spark, d).withColumns({
        "lat": F.lit(27.7), "lon": F.lit(68.9), "fetched_at": F.lit("2024-02-01").cast("timestamp")}))
    aqi = fx.raw_aqi(spark, d).withColumns({
        "lat": F.lit(27.7), "lon": F.lit(68.9), "source": F.lit(schemas.SOURCE_ARCHIVE),
        "fetched_at": F.lit("2024-02-01").cast("timestamp")})
    house = Warehouse(spark, _work_path(spark, "warehouse"))
    archive, forecast = (log.filter(F.col("seq") == n).drop("seq") for n in (1, 2))
    pipelines.ingest(house, archive, forecast, aqi)
    return house.raw_weather.read().drop("lat", "lon", "fetched_at")


@query
def trailing_window(spark, d):
    return expr.trailing_days(fx.raw_weather(spark, d), fx.at("2024-01-25 09:30:00"), 14).select(
        "city", "ts", "temp")


@query
def source_filter(spark, d):
    rows = fx.raw_weather(spark, d).filter(F.col("source") == schemas.SOURCE_FORECAST)
    return rows.select("city", "ts", "temp")


@query
def table_counts(spark, d):
    w, a = fx.raw_weather(spark, d), fx.raw_aqi(spark, d)
    return stats.table_counts(
        {"raw_weather": w, "raw_aqi": a, "joined": joins.merge_readings(w, a)})


@query
def shape_report(spark, d):
    return stats.shape_report(joined(spark, d).select("city", "ts", *ALL_MEASURES))


# --- scalar expressions ---------------------------------------------------------------

def _event_values(spark, d):
    return spark.read.parquet(f"{d}/events.parquet").select("event_id", "value")


@query
def pm25_to_aqi(spark, d):
    return _event_values(spark, d).select(
        "event_id", F.round(expr.pm25_to_aqi("value"), 6).alias("aqi"))


@query
def pm25_to_aqi_range_join(spark, d):
    df = joins.pm25_range_join(_event_values(spark, d), "value", "aqi")
    return rounded(df.select("event_id", "aqi"), "aqi")


@query
def rounding(spark, d):
    return _event_values(spark, d).select("event_id", expr.round1("value").alias("value"))


@query
def aqi_category(spark, d):
    return _event_values(spark, d).select(
        "event_id", expr.aqi_category("value").alias("category"),
        expr.aqi_color("value").alias("color"))


@query
def category_lookup(spark, d):
    return joins.category_join(_event_values(spark, d), "value").select(
        "event_id", "category", "zone", "advice")


@query
def us_aqi_filled(spark, d):
    return fx.raw_aqi(spark, d).select(
        "city", "ts", F.round(expr.fill_us_aqi(), 6).alias("us_aqi"))


@query
def calendar_features(spark, d):
    events = spark.read.parquet(f"{d}/events.parquet")
    return events.select("event_id", *[c.alias(n) for n, c in expr.calendar("ts").items()])


@query
def interactions(spark, d):
    df = fx.raw_weather(spark, d)
    made = expr.interactions(df.columns)
    return df.select("city", "ts", *[c.alias(n) for n, c in made.items()])


@query
def hourly_format(spark, d):
    return rounded(reports.hourly_table(predictions(spark, d)), "predicted_aqi")


@query
def today_rows(spark, d):
    return reports.current_weather(fx.raw_weather(spark, d), fx.at("2024-01-27 13:20:00"))["today"]


@query
def drop_sparse_rows(spark, d):
    return expr.drop_sparse(joined(spark, d).select("city", "ts", "temp", "humidity", "wind_speed",
                                                    "pm10", "pm2_5", "us_aqi"))


@query
def drop_any_null(spark, d):
    return expr.drop_missing(joined(spark, d)).select("city", "ts", *ALL_MEASURES)


# --- joins ----------------------------------------------------------------------------

@query
def weather_aqi_join(spark, d):
    return joined(spark, d)


@query
def join_suffixes(spark, d):
    def placed(df):
        return df.withColumns({"lat": F.lit(27.7058), "lon": F.lit(68.8574)})

    both = joins.merge_readings(placed(fx.raw_weather(spark, d)), placed(fx.raw_aqi(spark, d)))
    return both.select("city", "ts", "temp", "pm2_5", "lat_weather", "lon_weather", "lat_aqi", "lon_aqi")


@query
def semi_recent_actuals(spark, d):
    recent = tsop.last_rows(joined(spark, d).select("city", "ts"), 24)
    return joins.restrict_to(fx.raw_aqi(spark, d).select("city", "ts", "us_aqi"), recent)


@query
def nearest_reading(spark, d):
    return joins.nearest_reading(
        fx.raw_weather(spark, d).select("city", "ts", "temp", "humidity", "source"),
        expr.floor_hour(fx.at("2024-01-15 10:25:00")))


@query
def nearest_join(spark, d):
    probes = spark.read.parquet(f"{d}/events.parquet").select(
        "event_id", F.concat(F.lit("city_"), (F.col("user_id") % 3).cast("string")).alias("city"), "ts")
    return joins.nearest_join(probes, fx.raw_weather(spark, d).select("city", "ts", "pressure")).select(
        "event_id", "near_ts", "near_pressure")


@query
def nearest_join_tolerance(spark, d):
    """Line items against the dense half of the daily series, at most two days apart."""
    rows = daily(spark, d, "city", "ts", "us_aqi")
    return joins.nearest_join(
        rows.select("city", "ts"), rows.filter("us_aqi IS NOT NULL").select("city", "ts", "us_aqi"),
        tolerance_seconds=2 * 86400)


# --- fills and windows ----------------------------------------------------------------

@query
def ffill(spark, d):
    return tsop.forward_fill(joined(spark, d), ["temp", "pm2_5", "us_aqi"]).select(
        "city", "ts", "temp", "pm2_5", "us_aqi")


@query
def bfill(spark, d):
    return tsop.backward_fill(joined(spark, d), ["temp", "pm2_5", "us_aqi"]).select(
        "city", "ts", "temp", "pm2_5", "us_aqi")


@query
def fill_chain(spark, d):
    df = joined(spark, d).select("city", "ts", *ALL_MEASURES)
    return tsop.fill_then_median(df)


@query
def fill_median_fallback(spark, d):
    """One city never reports PM2.5, so that its gaps take the median of the others."""
    pm = F.when(F.col("city") != "city_1", F.col("pm2_5"))
    df = joined(spark, d).select("city", "ts", "temp", pm.alias("pm2_5"))
    return tsop.fill_then_median(df)


@query
def forecast_fill_zero(spark, d):
    """One city lacks all temperatures, so that its gaps become 0."""
    temp = F.when(F.col("city") != "city_2", F.col("temp"))
    df = fx.raw_weather(spark, d).select("city", "ts", temp.alias("temp"), "humidity")
    return tsop.fill_then_zero(df)


@query
def zscore_filter(spark, d):
    df = joined(spark, d).select("city", "ts", *schemas.OUTLIER_COLUMNS).na.fill(0.0)
    return outliers.zscore_filter(df)


@query
def zscore_many_series(spark, d):
    df = daily(spark, d).na.fill(0.0)
    return outliers.zscore_filter(df, ["pm2_5", "temp", "humidity"], stored=True)


@query
def rolling3_rows(spark, d):
    df = joined(spark, d).select("city", "ts", "pm2_5", "temp")
    out = tsop.rolling_mean(df, ["pm2_5", "temp"])
    return rounded(out, "pm2_5_rolling_3h", "temp_rolling_3h")


@query
def rolling3_time(spark, d):
    df = joined(spark, d).select("city", "ts", "pm2_5", "temp")
    out = tsop.rolling_mean(df, ["pm2_5", "temp"], by="time")
    return rounded(out, "pm2_5_rolling_3h", "temp_rolling_3h")


@query
def aqi_lags(spark, d):
    return tsop.add_lags(joined(spark, d).select("city", "ts", "us_aqi"))


@query
def aqi_lags_many_series(spark, d):
    return tsop.add_lags(daily(spark, d, "city", "ts", "us_aqi"))


@query
def aqi_lags_time(spark, d):
    return tsop.add_lags(joined(spark, d).select("city", "ts", "us_aqi"), by="time")


@query
def sequence_windows(spark, d):
    df = joined(spark, d).select("city", "ts", "pressure", "ozone", "us_aqi")
    seq = tsop.sequence_windows(df, ["pressure", "ozone"], "us_aqi")
    total = F.aggregate("sequence.ozone", F.lit(0.0), lambda acc, x: acc + x)
    return seq.select(
        "city", "ts", F.size("sequence").alias("steps"),
        F.get("sequence", F.lit(0))["pressure"].alias("first_pressure"),
        F.get("sequence", F.lit(23))["pressure"].alias("last_pressure"),
        F.round(total, 6).alias("sum_ozone"), "target")


@query
def chrono_split(spark, d):
    return tsop.chrono_split(daily(spark, d, "city", "ts"))


@query
def cv_folds(spark, d):
    return tsop.cv_folds(daily(spark, d, "city", "ts"))


@query
def row_positions(spark, d):
    return tsop.with_position(daily(spark, d, "city", "ts"), total="n")


@query
def latest_aqi(spark, d):
    return reports.latest_aqi(fx.raw_aqi(spark, d))


@query
def last_168(spark, d):
    return tsop.last_rows(fx.raw_aqi(spark, d).select("city", "ts", "us_aqi"), 168)


@query
def last_events(spark, d):
    """The latest rows of a whole table."""
    events = spark.read.parquet(f"{d}/events.parquet").select("event_id", "ts", "value")
    return tsop.last_rows(events, 20, keys=(), ties=("event_id",))


@query
def first_24_forecast(spark, d):
    return tsop.first_rows(predictions(spark, d).select("city", "ts", "aqi_category"), 24)


@query
def forecast_144(spark, d):
    return mlf.forecast_weather(fx.raw_weather(spark, d), now())


# --- forecast features ----------------------------------------------------------------

def _forecast_features(spark, d):
    return mlf.forecast_features(
        mlf.forecast_weather(fx.raw_weather(spark, d), now()), fx.raw_aqi(spark, d),
        split=False)  # at most 144 rows per series


@query
def forecast_features(spark, d):
    out = _forecast_features(spark, d).drop("clouds", "source")
    return rounded(out, "temp_rolling_3h")


@query
def feature_align(spark, d):
    return rounded(mlf.align_features(_forecast_features(spark, d), ALIGNED), "temp_rolling_3h")


@query
def preprocess(spark, d):
    """The whole preparation stage: join, index fill, gap fill, outlier filter, features."""
    out = pipelines.clean(fx.raw_weather(spark, d), fx.raw_aqi(spark, d)).drop("source")
    return rounded(out, "us_aqi", "pm2_5_rolling_3h", "temp_rolling_3h")


# --- aggregates -----------------------------------------------------------------------

@query
def daily_summary(spark, d):
    return stats.daily_summary(predictions(spark, d))


@query
def daily_summary_filled(spark, d):
    """Per city and day: mean, min and max of the repaired index, with its category."""
    filled = joined(spark, d).withColumn("us_aqi", expr.fill_us_aqi())
    return stats.daily_summary(filled, "us_aqi")


@query
def forecast_summary(spark, d):
    return rounded(stats.value_summary(predictions(spark, d), keys=("city",)), "mean", "min", "max")


@query
def headline_metrics(spark, d):
    return rounded(stats.headline_metrics(predictions(spark, d)), "avg_aqi", "max_aqi", "min_aqi")


@query
def category_counts(spark, d):
    return stats.category_counts(predictions(spark, d), keys=("city",))


@query
def category_share(spark, d):
    return rounded(stats.category_share(predictions(spark, d)), "share")


@query
def temp_summary(spark, d):
    out = stats.value_summary(predictions(spark, d), "temp").select("mean", "min", "max")
    return rounded(out, "mean", "min", "max")


_PROFILED = ["temp", "humidity", "pressure", "pm2_5", "us_aqi", "source"]


@query
def feature_profile(spark, d):
    out = stats.feature_profile(materialize(joined(spark, d).select("city", "ts", *_PROFILED)))
    return rounded(out, "mean", "std", "min", "max", "median")


@query
def feature_profile_by_city(spark, d):
    rows = materialize(joined(spark, d).select("city", "ts", "temp", "us_aqi"))
    out = stats.feature_profile(rows, keys=("city",))
    return rounded(out, "mean", "std", "min", "max", "median")


@query
def describe(spark, d):
    out = stats.describe(daily(spark, d))
    return rounded(out, "mean", "std", "min", "q25", "q50", "q75", "max")


@query
def missing_report(spark, d):
    df = joined(spark, d).select("city", "ts", *ALL_MEASURES)
    return rounded(stats.missing_report(df), "pct")


@query
def aqi_stats(spark, d):
    return rounded(stats.aqi_stats(fx.raw_aqi(spark, d)), "mean", "median", "std", "min", "max")


@query
def event_quantiles(spark, d):
    """Exact quartiles of every event value, per event type."""
    events = spark.read.parquet(f"{d}/events.parquet").select("event_type", "value")
    q = stats.exact_quantiles(events, ["value"], [0.25, 0.5, 0.75], keys=("event_type",))
    return q.select("event_type", *[
        F.round(F.col("value")[i], 6).alias(n) for i, n in enumerate(("q25", "q50", "q75"))])


@query
def median_imputation(spark, d):
    return rounded(stats.median_of(joined(spark, d), ["temp", "pm2_5"], keys=("city",)), "temp", "pm2_5")


@query
def recent_trend(spark, d):
    return rounded(stats.recent_trend(fx.raw_aqi(spark, d)),
                   "mean", "std", "min", "max", "latest", "mean_recent")


@query
def hist_pm25(spark, d):
    return rounded(stats.histogram(joined(spark, d), "pm2_5", 50), "bin_low", "bin_high")


@query
def hist_predicted(spark, d):
    return rounded(stats.histogram(predictions(spark, d), "predicted_aqi", 30), "bin_low", "bin_high")


@query
def box_summary(spark, d):
    rows = materialize(joined(spark, d).select(*schemas.OUTLIER_COLUMNS))
    out = stats.box_summary(rows, schemas.OUTLIER_COLUMNS)
    return rounded(out, "q25", "q50", "q75", "whisker_low", "whisker_high")


def _with_constant(spark, d):
    rows = joined(spark, d).select("temp", "humidity", "pressure", "pm2_5", "us_aqi",
                                   F.lit(27.7058).alias("lat"))
    return materialize(rows)


@query
def corr_matrix(spark, d):
    return rounded(stats.corr_matrix(_with_constant(spark, d)), "r")


@query
def corr_target(spark, d):
    return rounded(stats.corr_target(_with_constant(spark, d)), "r")


# --- model quality --------------------------------------------------------------------

def _guesses(spark, d) -> DataFrame:
    """Three closed-form predictors beside the repaired index, flagged train or test."""
    rows = fx.raw_aqi(spark, d).withColumn("actual", expr.fill_us_aqi()).filter("actual IS NOT NULL")
    lagged = tsop.add_lags(rows.select("city", "ts", "actual", "pm10", "pm2_5", "european_aqi"),
                           "actual", [1], prefix="lag_")
    zero = F.lit(0.0)
    return tsop.chrono_split(lagged.select(
        "city", "ts", "actual",
        F.coalesce(F.col("lag_1"), zero).alias("Persistence"),
        (F.coalesce(F.col("pm10"), zero) * 0.5 + F.coalesce(F.col("pm2_5"), zero) * 0.5).alias("Particles"),
        (F.col("european_aqi") * 1.5).alias("Scaled"),
    ))


_MODELS = ["Persistence", "Particles", "Scaled"]


def _quality(spark, d) -> DataFrame:
    long = _guesses(spark, d).unpivot(
        ["city", "ts", "actual", "is_train"], _MODELS, "model_name", "predicted")
    return stats.regression_metrics(long, keys=("model_name", "is_train"))


def _model_rows(spark, d) -> DataFrame:
    """Registry rows whose metrics are the measured quality of the closed-form predictors."""
    part = F.when(F.col("is_train"), F.lit("_train")).otherwise(F.lit("_test"))
    entries = F.array(*[
        F.struct(F.concat(F.lit(m), part).alias("key"), F.col(m).alias("value"))
        for m in ("r2", "mae", "rmse")])
    return (
        _quality(spark, d).select("model_name", F.inline(entries))
        .groupBy("model_name")  # six metrics per model
        .agg(F.map_from_entries(F.collect_list(F.struct("key", "value"))).alias("metrics"))
        .withColumn("status", F.lit("active"))
    )


@query
def error_rows(spark, d):
    actual = fx.raw_aqi(spark, d).filter("us_aqi IS NOT NULL").select("city", "ts", F.col("us_aqi").alias("actual"))
    predicted = fx.raw_weather(spark, d).select(
        "city", "ts", F.coalesce(F.col("temp"), F.lit(0.0)).alias("predicted"))
    out = scoring.error_rows(joins.pair_by_key(predicted, actual))
    return rounded(out, "abs_error", "error_pct")


@query
def regression_metrics(spark, d):
    return rounded(_quality(spark, d), "r2", "mae", "rmse")


@query
def model_melt(spark, d):
    comparison = registry.comparison_rows(_model_rows(spark, d))
    return rounded(stats.melt_metrics(comparison, "R2"), "value")


@query
def model_comparison(spark, d):
    out = registry.comparison_rows(_model_rows(spark, d))
    return out.select("Model", *[F.round(f"`{c}`", 6).alias(c) for c in out.columns if c != "Model"])


@query
def comparison_file(spark, d):
    """The comparison table written as CSV and read back."""
    path = _work_path(spark, "comparison")
    registry.comparison_rows(_model_rows(spark, d)).write.csv(path, header=True)
    back = spark.read.schema(schemas.MODEL_COMPARISON).csv(path, header=True)
    return back.select("Model", *[F.round(f"`{c}`", 6).alias(c) for c in back.columns if c != "Model"])


@query
def best_model(spark, d):
    best = registry.best_model(_model_rows(spark, d))
    return best.select("model_name", F.round(expr.metric("r2_test"), 6).alias("r2_test"))


@query
def model_status(spark, d):
    return rounded(registry.model_report(_model_rows(spark, d)), "r2_test", "mae_test", "rmse_test")


@query
def metadata_merge(spark, d):
    profile = stats.feature_profile(materialize(joined(spark, d).select("city", "ts", *_PROFILED)))
    new = rounded(profile.select("feature_name", "count", "null_count", "mean", "median"), "mean", "median")
    return merge_columns(schemas.feature_dim(spark), new, key="feature_name")


@query
def feature_store(spark, d):
    """Descriptions and statistics after registering and storing the features."""
    store = metadata.FeatureStore(Warehouse(spark, _work_path(spark, "warehouse")))
    store.register_defaults()
    store.store(joined(spark, d).select("city", "ts", *_PROFILED))
    out = store.metadata().select(
        "feature_name", "description", "data_type", "source",
        *[f"statistics.{c}" for c in ("count", "null_count", "mean", "median")])
    return rounded(out, "mean", "median")


# --- Spark ML: trees have no SQL, so the queries return what must hold for any of them -----

_TRAINED: dict[tuple[str, str], tuple[Warehouse, DataFrame, DataFrame]] = {}


def _trained(spark, d) -> tuple[Warehouse, DataFrame, DataFrame]:
    """The three models with the full settings, fitted once for a session and data folder."""
    known = (spark.sparkContext.applicationId, d)
    if known not in _TRAINED:
        house = Warehouse(spark, _work_path(spark, "warehouse"))
        weather, aqi = materialize(fx.raw_weather(spark, d)), materialize(fx.raw_aqi(spark, d))
        house.features.overwrite(house.preprocessed.overwrite(pipelines.clean(weather, aqi)))
        pipelines.train(house, training.TrainingPlan())
        _TRAINED[known] = house, weather, aqi
    return _TRAINED[known]


def _near(a, b) -> Column:
    return F.coalesce(F.abs(a - b) <= 1e-9 * (1 + F.abs(b)), a.isNull() & b.isNull())


_STUMP_FEATURES = ["hour", "clouds", "carbon_monoxide", "nitrogen_dioxide"]


@query
def regularised_boosting(spark, d):
    """The splits of three rounds of depth 1, without drawing rows or features."""
    rows = joined(spark, d).withColumn("hour", F.hour("ts").cast("double")).select(*_STUMP_FEATURES, "us_aqi").dropna()
    data = VectorAssembler(inputCols=_STUMP_FEATURES, outputCol="features").transform(materialize(rows))
    model = boosting.fit(data, boosting.Boosting(rounds=3, depth=1, learning_rate=0.3, subsample=1, column_sample=1, bins=256), target="us_aqi")
    splits = [(i + 1, _STUMP_FEATURES[t["feature"][0]], t["limit"][0], t["gain"][0], t["value"][1], t["value"][2])
              for i, t in enumerate(json.loads(model.getOrDefault(model.ensemble))["trees"])]
    out = spark.createDataFrame(splits, "round int, feature string, cut double, gain double, left_value double, right_value double")
    return rounded(rounded(out, "left_value", "right_value"), "gain", digits=3)


@query
def train_compare(spark, d):
    """Per model: whether its registered metrics are those of its own predictions, in the registry and in the comparison
    table, and whether it errs less on the test rows than the training mean and than the last known index do."""
    house, _, _ = _trained(spark, d)
    models = registry.ModelRegistry(house)
    plan = training.TrainingPlan()
    frame = training.training_frame(house.features.read(), plan)
    scored = None
    for row in models.models().collect():  # three models
        model, row = models.load(row)
        part = model.transform(frame).select(F.lit(row["model_name"]).alias("Model"), "is_train", "prediction", plan.target)
        scored = part if scored is None else scored.unionByName(part)
    again = stats.regression_metrics(scored, "prediction", plan.target, keys=("Model", "is_train"))
    part = F.when(F.col("is_train"), F.lit("train")).otherwise(F.lit("test"))
    stored = models.models().select(F.col("model_name").alias("Model"), "metrics")
    file = models.read_comparison().withColumnRenamed("R2 (Test)", "r2_file").select("Model", "r2_file")
    joined_ = again.join(stored, "Model").join(file, "Model")
    match = F.lit(True)
    for name in ("r2", "mae", "rmse"):
        match &= _near(F.try_element_at("metrics", F.concat(F.lit(f"{name}_"), part)), F.col(name))
    match &= F.col("is_train") | _near(F.col("r2_file"), F.col("r2"))
    plain = baselines(frame, plan)
    # The registered error is compared, which ``metrics_match`` ties to the predictions.
    test_error = F.max(F.when(~F.col("is_train"), F.try_element_at("metrics", F.lit("rmse_test"))))
    out = joined_.groupBy("Model").agg(F.bool_and(match).alias("metrics_match"), F.count("*").alias("parts"), test_error.alias("_error"))
    return out.select(
        "Model", "metrics_match", "parts", (F.col("_error") < plain["mean"]).alias("beats_mean"),
        (F.col("_error") < plain["persistence"]).alias("beats_persistence"), F.lit(plain["rows"]).alias("test_rows"),
        *[F.round(F.lit(plain[n]), 4).alias(f"rmse_{n}") for n in ("mean", "persistence")])


def baselines(frame: DataFrame, plan: training.TrainingPlan) -> dict[str, float]:
    """Test rows, and the root mean square errors on them of the training mean and of the last index."""
    mean = frame.filter("is_train").agg(F.avg(plan.target)).first()[0]
    y = F.col(plan.target)
    row = frame.filter("NOT is_train").agg(
        F.count("*").alias("rows"), F.sqrt(F.avg((y - mean) ** 2)).alias("mean"),
        F.sqrt(F.avg((y - F.col("aqi_lag_1")) ** 2)).alias("persistence")).first()
    return row.asDict()


def _best(house):
    models = registry.ModelRegistry(house)
    return models, models.load(models.best())


@query
def score_forecast(spark, d):
    """Forecast rows scored by the best of three models: the given columns, whether the category is
    that of the prediction, and whether the model is the one with the highest test R2."""
    house, weather, aqi = _trained(spark, d)
    models, (model, row) = _best(house)
    feats = mlf.forecast_features(mlf.forecast_weather(weather, now()), aqi, split=False)
    out = scoring.score_forecast(feats, model, row["feature_names"], row["model_name"])
    top = models.models().agg(F.max(expr.metric("r2_test"))).first()[0]
    return out.select(
        "city", "ts", "humidity", "hour", F.col("predicted_aqi").isNotNull().alias("scored"),
        F.col("aqi_category").eqNullSafe(expr.aqi_category("predicted_aqi")).alias("category_fits"),
        F.lit((row["metrics"].get("r2_test") or 0.0) == top).alias("is_best"))


@query
def backtest(spark, d):
    """The last 24 stored rows of every city against the actual index."""
    house, _, aqi = _trained(spark, d)
    _, (model, row) = _best(house)
    out = scoring.backtest(house.features.read(), aqi, model, row["feature_names"])
    return out.select(
        "city", "ts", "actual", _near(F.col("abs_error"), F.abs(F.col("predicted") - F.col("actual"))).alias("error_fits"))


@query
def feature_importance(spark, d):
    """The features of the best model and the sum of their importances."""
    house, _, _ = _trained(spark, d)
    _, (model, row) = _best(house)
    out = training.feature_importance(spark, model, row["feature_names"])
    total = out.agg(F.round(F.sum("importance"), 6)).first()[0]
    return out.select("feature_name", F.lit(total).alias("total"), (F.col("importance") >= 0).alias("is_share"))


@query
def registered_features(spark, d):
    """Numbered features of one registered model."""
    house, _, _ = _trained(spark, d)
    return registry.feature_list(registry.ModelRegistry(house).models(), training.GRADIENT_BOOSTING)


@query
def pipeline_forecast(spark, d):
    """The stored forecast of the whole run: its daily table against its rows."""
    house, weather, aqi = _trained(spark, d)
    house.raw_weather.overwrite(weather.withColumns({
        "lat": F.lit(27.7), "lon": F.lit(68.9), "fetched_at": F.lit("2024-02-01").cast("timestamp")}))
    house.raw_aqi.overwrite(aqi.withColumns({
        "lat": F.lit(27.7), "lon": F.lit(68.9), "source": F.lit(schemas.SOURCE_ARCHIVE),
        "fetched_at": F.lit("2024-02-01").cast("timestamp")}))
    made = pipelines.predict_aqi_forecast(house, now())
    mine = made.rows.groupBy("city", F.to_date("ts").alias("day")).agg(
        F.bround(F.avg("predicted_aqi"), 1).alias("mean"), F.count("*").alias("hours"))
    return made.daily.join(mine, ["city", "day"]).select(
        "city", "day", "hours", (F.abs(F.col("avg_aqi") - F.col("mean")) <= 0.11).alias("mean_fits"),
        (F.col("category") == expr.aqi_category("avg_aqi")).alias("category_fits"))


@query
def global_order(spark, d):
    """The place of every event by value, largest first, in one order of the whole table."""
    events = spark.read.parquet(f"{d}/events.parquet").select("event_id", "event_type", F.col("value").cast("double").alias("value"))
    return global_rank(events, [F.desc("value"), F.asc("event_id")])


@query
def grouped_describe(spark, d):
    """Counts, moments, ends and quartiles of events by type, by one search."""
    events = spark.read.parquet(f"{d}/events.parquet").select("event_type", F.col("value").cast("double").alias("value"), "user_id")
    found = stats.describe(events, ["value", "user_id"], keys=("event_type",))
    return rounded(found, "mean", "std", "min", "q25", "q50", "q75", "max")


# --- report pages and stages as runs ------------------------------------------------------

def _cells(page: str, report: reports.Report) -> DataFrame:
    """The compared cells of a page as (frame, id, name, value, label)."""
    out = None
    for frame, (ids, columns) in PAGES[page].items():
        name = F.concat_ws("|", *[F.col(f"`{c}`").cast("string") for c in ids]) if ids else F.lit("")
        cells = F.array(*[
            F.struct(
                F.lit(c.lstrip("=")).alias("name"),
                (F.lit(None) if c.startswith("=") else F.round(F.col(f"`{c}`").cast("double"), 6)).cast("double").alias("value"),
                (F.col(f"`{c[1:]}`") if c.startswith("=") else F.lit(None)).cast("string").alias("label"))
            for c in columns])
        part = report[frame].select(F.lit(frame).alias("frame"), name.alias("id"), F.inline(cells))
        out = part if out is None else out.unionByName(part)
    return out


@query
def page_overview(spark, d):
    raw = materialize(fx.raw_aqi(spark, d))
    return _cells("page_overview", reports.overview(raw, joined(spark, d), _model_rows(spark, d)))


@query
def page_data_analysis(spark, d):
    rows = materialize(joined(spark, d).select("city", "ts", *ALL_MEASURES))
    return _cells("page_data_analysis", reports.data_analysis(rows, columns=list(ANALYSED)))


@query
def page_model_performance(spark, d):
    return _cells("page_model_performance", reports.model_performance(materialize(registry.comparison_rows(_model_rows(spark, d)))))


@query
def page_current_prediction(spark, d):
    made = materialize(predictions(spark, d))
    return _cells("page_current_prediction", reports.current_prediction(made, fx.at("2024-01-28 05:20:00")))


@query
def page_forecast(spark, d):
    return _cells("page_forecast", reports.forecast_report(materialize(predictions(spark, d))))


@query
def page_accuracy(spark, d):
    """Recent readings, their trend, the models' verdicts, and the errors of a closed-form prediction with their summary."""
    raw = materialize(fx.raw_aqi(spark, d))
    predicted = fx.raw_weather(spark, d).select("city", "ts", F.coalesce(F.col("temp"), F.lit(0.0)).alias("predicted"))
    actual = raw.filter("us_aqi IS NOT NULL").select("city", "ts", F.col("us_aqi").alias("actual"))
    errors = materialize(scoring.error_rows(joins.pair_by_key(predicted, actual)))
    return _cells("page_accuracy", reports.accuracy_report(raw, _model_rows(spark, d), errors))


def _placed(rows: DataFrame, source: Column | None = None) -> DataFrame:
    """Readings with the columns that raw tables have besides."""
    extra = {"lat": F.lit(27.7), "lon": F.lit(68.9), "fetched_at": F.lit("2024-02-01").cast("timestamp")}
    return rows.withColumns(extra if source is None else {**extra, "source": source})


@query
def feature_stage(spark, d):
    """The stage from the preprocessed table to the feature store, with what it knows of every feature."""
    house = Warehouse(spark, _work_path(spark, "warehouse"))
    house.preprocessed.overwrite(joined(spark, d).select("city", "ts", *_PROFILED))
    pipelines.engineer_and_store_features(house)
    out = FeatureStore(house).metadata().select(
        "feature_name", "description", "data_type", "source",
        *[f"statistics.{c}" for c in ("count", "null_count", "mean", "median")])
    return rounded(out, "mean", "median")


@query
def end_to_end(spark, d):
    """Rows of every table after the whole run from feeds to the scored forecast, with few trees, and after a second run."""
    house = Warehouse(spark, _work_path(spark, "warehouse"))
    log = materialize(_placed(fx.weather_feed(spark, d)))
    archive, forecast = (log.filter(F.col("seq") == n).drop("seq") for n in (1, 2))
    aqi = materialize(_placed(fx.raw_aqi(spark, d), F.lit(schemas.SOURCE_ARCHIVE)))
    plan = training.TrainingPlan(forest_trees=3, xgb_rounds=2, gbt_rounds=2)
    out = None
    for run in (1, 2):
        made = pipelines.run(house, archive, forecast, aqi, now(), plan)
        counts = materialize(stats.table_counts({
            "raw_weather": house.raw_weather.read(), "raw_aqi": house.raw_aqi.read(), "preprocessed": house.preprocessed.read(),
            "features": house.features.read(), "models": house.model_registry.read(), "predictions": house.predictions.read(),
            "scored": made.rows.filter("predicted_aqi IS NOT NULL AND aqi_category IS NOT NULL"), "days": made.daily,
        })).withColumn("run", F.lit(run))
        out = counts if out is None else out.unionByName(counts)
    return out


@query
def fallback_source(spark, d):
    """The preprocessed table where there is one, else the joined raw tables."""
    found = None
    for prepared in (False, True):
        house = Warehouse(spark, _work_path(spark, "warehouse"))
        house.raw_weather.overwrite(_placed(fx.raw_weather(spark, d)))
        house.raw_aqi.overwrite(_placed(fx.raw_aqi(spark, d), F.lit(schemas.SOURCE_ARCHIVE)))
        if prepared:
            house.preprocessed.overwrite(joined(spark, d).filter("us_aqi IS NOT NULL").withColumn("temp", F.lit(1.0)))
        rows = preprocessed_or_joined(house).select("city", "ts", "temp", "us_aqi", F.lit(prepared).alias("prepared"))
        found = rows if found is None else found.unionByName(rows)
    return found


@query
def drop_missing_target(spark, d):
    """Rows that have the target and a time, whatever else they lack."""
    broken = joined(spark, d).withColumn("ts", F.when(F.col("clouds") % 5 != 0, F.col("ts")))
    return expr.drop_missing(broken, "us_aqi", "ts").select("city", "ts", "temp", "us_aqi")


@query
def scaled_features(spark, d):
    """The optional scaling stage: fitted on the rows before a day, applied to those from it on."""
    rows = materialize(joined(spark, d).select("city", "ts", "temp", "humidity", "ozone").dropna())
    early = F.col("ts") < fx.at("2024-01-15 00:00:00")
    fitted = training.assembly(["temp", "humidity", "ozone"], scale=True).fit(rows.filter(early))
    x = vector_to_array("features")
    return fitted.transform(rows.filter(~early)).select(
        "city", "ts", *[F.round(x[i], 6).alias(c) for i, c in enumerate(("temp", "humidity", "ozone"))])


# --- tables as a whole ------------------------------------------------------------------

@query
def failed_writes(spark, d):
    """A table of many months after an upsert and an overwrite that fail in one of them, and after an upsert that does not."""
    rows = daily(spark, d, "city", "ts", "temp")
    table = Table(spark, _work_path(spark, "daily"), monthly=True)
    table.overwrite(rows)
    broken = rows.withColumn("temp", F.when(F.year("ts") == 1995, F.raise_error(F.lit("broken"))).otherwise(F.lit(-1.0)))
    failures = 0
    for write in (table.upsert, table.overwrite):
        try:
            write(broken)
        except Exception as e:  # Spark wraps the error in ways that differ by where it is raised
            if "broken" not in str(e):
                raise
            failures += 1

    def by_year(step: str) -> DataFrame:
        return table.read().groupBy(F.year("ts").alias("year")).agg(F.count("*").alias("n"), F.sum("temp").alias("total")).select(
            F.lit(step).alias("step"), F.lit(failures).alias("failures"), "year", "n", "total")

    kept = materialize(by_year("kept"))
    table.upsert(rows.filter((F.year("ts") == 1995) & (F.month("ts") <= 6)).withColumn("temp", F.col("temp") + 1))
    return kept.unionByName(by_year("upserted"))


def _stored_weather(spark, d) -> Table:
    """Both feeds in a monthly table, the forecast upserted over the archive."""
    table = Table(spark, _work_path(spark, "weather"), monthly=True)
    log = materialize(fx.weather_feed(spark, d))
    for seq in (1, 2):
        table.upsert(log.filter(F.col("seq") == seq), seq="seq")
    return table


@query
def series_lengths(spark, d):
    """What a stored table keeps about its series beside the rows, after an upsert into a month that it has."""
    return _stored_weather(spark, d).lengths()


@query
def stored_fill(spark, d):
    """Forward fill and trailing mean on a stored table, by the lengths kept beside it."""
    table = _stored_weather(spark, d)
    lengths = table.lengths()
    filled = tsop.forward_fill(table.read(), ["temp", "wind_speed"], split=lengths)
    return rounded(tsop.rolling_mean(filled, ["humidity"], split=lengths), "humidity_rolling_3h").select(
        "city", "ts", "temp", "wind_speed", "humidity_rolling_3h")


# --- streaming ------------------------------------------------------------------------

_LANDINGS = 5


def _landed_events(spark, d, take: Callable[[DataFrame], object], again: bool = False) -> None:
    """Events in five landings of six days each; ``take`` runs the stream after every one.

    Every 50th event of the first ten days comes with the last landing, long after the watermark. With ``again``
    every 7th event is delivered once more by the next landing, with another value.
    """
    landing = _work_path(spark, "landing")
    at = (F.dayofmonth("ts") - 1) / 6
    number = F.when((F.col("event_id") % 50 == 0) & (F.dayofmonth("ts") <= 10), _LANDINGS - 1).otherwise(
        F.least(F.floor(at).cast("int"), F.lit(_LANDINGS - 1)))
    events = spark.read.parquet(f"{d}/events.parquet").select(
        "event_id", F.concat(F.lit("city_"), (F.col("user_id") % 3).cast("string")).alias("city"), "ts",
        F.col("value").cast("decimal(18,2)").alias("value"), number.alias("landing"))
    if again:
        repeated = events.filter((F.col("event_id") % 7 == 0) & (F.col("landing") < _LANDINGS - 1))
        events = events.unionByName(repeated.withColumns({
            "value": (F.col("value") + 1000).cast("decimal(18,2)"), "landing": F.col("landing") + 1}))
    events = materialize(events)
    for n in range(_LANDINGS):
        events.filter(F.col("landing") == n).drop("landing").write.mode("append").parquet(landing)
        stream = spark.readStream.schema(events.drop("landing").schema).parquet(landing)
        take(stream)


@query
def stream_hourly_late(spark, d):
    """Hourly aggregation over five micro-batches that keeps late events: per (city, hour) the events in time, their
    sum, and the late ones."""
    out, progress, late = Table(spark, _work_path(spark, "hourly"), monthly=True), _work_path(spark, "progress"), _work_path(spark, "late")
    _landed_events(spark, d, lambda stream: streaming.hours_with_late(stream, out, late, progress).awaitTermination())
    missed = spark.read.parquet(late).groupBy("city", expr.floor_hour("ts").alias("ts")).agg(F.count("*").alias("late"))
    return out.read().join(missed, ["city", "ts"], "full").select(
        "city", "ts", F.coalesce("n", F.lit(0)).alias("n"), F.col("total").cast("double").alias("total"),
        F.coalesce("late", F.lit(0)).alias("late"))


@query
def first_arrivals(spark, d):
    """The first delivery of each event over five micro-batches, by a state that the watermark bounds, and the number of
    deliveries that came after it."""
    out, progress, late = _work_path(spark, "first"), _work_path(spark, "progress"), []

    def take(stream: DataFrame) -> None:
        run = streaming.append_stream(streaming.first_by_key(stream, keys=("event_id",), late="2 days"), out, progress)
        run.awaitTermination()
        late.append(streaming.late_rows(run))

    _landed_events(spark, d, take, again=True)
    return spark.read.parquet(out).select(
        "event_id", "city", "ts", F.col("value").cast("double").alias("value"), F.lit(sum(late)).cast("bigint").alias("late"))


@query
def stream_hourly(spark, d):
    """Hourly aggregation over five micro-batches, each update upserted by (city, hour). Rows that
    come after the watermark are dropped."""
    out, progress = Table(spark, _work_path(spark, "hourly"), monthly=True), _work_path(spark, "progress")
    _landed_events(spark, d, lambda stream: streaming.upsert_stream(
        streaming.hourly_readings(stream), out, progress, output_mode="update").awaitTermination())
    return out.read().select(
        "city", "ts", "n", F.col("total").cast("double").alias("total"),
        F.col("low").cast("double").alias("low"), F.col("high").cast("double").alias("high"))


@query
def stream_upsert(spark, d):
    """Two landings of the weather log, each taken by an incremental run."""
    landing, progress = _work_path(spark, "landing"), _work_path(spark, "progress")
    out = Table(spark, _work_path(spark, "raw_weather"), monthly=True)
    log = materialize(fx.weather_feed(spark, d))
    for seq in (1, 2):
        log.filter(F.col("seq") == seq).write.mode("append").parquet(landing)
        stream = spark.readStream.schema(log.schema).parquet(landing)
        streaming.upsert_stream(stream, out, progress, seq="seq").awaitTermination()
    return out.read()


@query
def stream_first_by_key(spark, d):
    """The first event of each (city, hour) over five micro-batches: of the earliest landing the one
    with the lowest id. Later ones never replace it."""
    out, progress = Table(spark, _work_path(spark, "first"), monthly=True), _work_path(spark, "progress")
    _landed_events(spark, d, lambda stream: streaming.upsert_stream(
        stream.withColumn("hour_ts", expr.floor_hour("ts")), out, progress, keys=("city", "hour_ts"),
        seq="event_id", keep="first").awaitTermination())
    return out.read().select("city", "hour_ts", "event_id")


# --- NULL keys, NaN, broken payloads, short instants ------------------------------------

def _both_modes(make: Callable[[bool], DataFrame]) -> DataFrame:
    """The rows of one operator with and without cutting the series."""
    return make(False).withColumn("split", F.lit(False)).unionByName(make(True).withColumn("split", F.lit(True)))


def _nameless(spark, d) -> DataFrame:
    """Weather readings in which one city has no name."""
    city = F.when(F.col("city") != "city_0", F.col("city")).alias("city")
    return materialize(fx.raw_weather(spark, d).select(city, "ts", "temp", "humidity"))


@query
def null_key_series(spark, d):
    rows = _nameless(spark, d)

    def made(split: bool) -> DataFrame:
        filled = tsop.forward_fill(rows, ["temp"], split=split, bucket_seconds=86400 if split else None)
        rolled = tsop.rolling_mean(filled, ["humidity"], split=split)
        lagged = tsop.add_lags(rolled, "temp", (1, 3), prefix="lag_", split=split)
        placed = tsop.with_position(lagged, split=split)
        return rounded(placed, "humidity_rolling_3h")

    return _both_modes(made)


@query
def null_key_nearest(spark, d):
    """The nearest reading of every event, where one city has no name, in both modes."""
    probes = spark.read.parquet(f"{d}/events.parquet").select(
        "event_id", F.nullif(F.concat(F.lit("city_"), (F.col("user_id") % 3).cast("string")), F.lit("city_0")).alias("city"), "ts")
    readings = _nameless(spark, d).select("city", "ts", "humidity")
    return _both_modes(lambda split: joins.nearest_join(
        probes, readings, split=split, bucket_seconds=86400 if split else None).select("event_id", "city", "near_ts", "near_humidity"))


@query
def null_key_last_known(spark, d):
    """The last known index beside every forecast row, where one city has no name and another no reading."""
    def named(rows: DataFrame) -> DataFrame:
        return rows.withColumn("city", F.nullif("city", F.lit("city_0")))

    ahead = named(fx.raw_weather(spark, d).filter(F.col("ts") >= now())).select("city", "ts")
    known = named(fx.raw_aqi(spark, d)).filter("city is null or city <> 'city_1'")
    return joins.last_known(ahead, known, names=["recent", "again"])


@query
def null_key_marks(spark, d):
    """Training flags and folds, a share of 1 among them."""
    rows = _nameless(spark, d).select("city", "ts")
    return _both_modes(lambda split: tsop.cv_folds(
        tsop.chrono_marks(rows, {"is_train": 0.8, "all_of_it": 1.0}, split=split), split=split))


@query
def null_key_profile(spark, d):
    """Profile per city with a nameless one, NaN counted as missing."""
    rows = _nameless(spark, d).withColumn(
        "temp", F.when(F.hour("ts") % 7 == 3, F.lit(float("nan"))).otherwise(F.col("temp")))
    out = stats.feature_profile(rows, keys=("city",)).select(
        "city", "feature_name", "count", "null_count", "mean", "min", "max", "median")
    return rounded(out, "mean", "min", "max", "median")


@query
def null_key_zscore(spark, d):
    return outliers.zscore_filter(_nameless(spark, d).na.fill(0.0, ["temp", "humidity"]), ("temp", "humidity"))


@query
def quantiles_odd_values(spark, d):
    """Quartiles of values with NaN and infinities, sorted whole and searched."""
    value = F.when(F.col("event_id") % 11 == 0, F.lit(float("nan"))).when(
        F.col("event_id") % 101 == 0, F.lit(float("inf"))).when(
        F.col("event_id") % 103 == 0, F.lit(float("-inf"))).otherwise(F.col("value"))
    rows = materialize(spark.read.parquet(f"{d}/events.parquet").select("event_type", value.alias("value")))

    def made(searched: bool) -> DataFrame:
        q = exact_quantiles(rows, ["value"], [0.25, 0.5, 0.75], keys=("event_type",),
                            max_interior=20 if searched else 10**9)
        return q.select("event_type", *[F.round(F.col("value")[i], 6).alias(n) for i, n in enumerate(("q25", "q50", "q75"))],
                        F.lit(searched).alias("searched"))

    return made(False).unionByName(made(True))


@query
def corr_with_nan(spark, d):
    """Correlations of a column with NaN: they count as missing."""
    rows = fx.raw_weather(spark, d).select("humidity", F.when(
        F.hour("ts") % 5 == 1, F.lit(float("nan"))).otherwise(F.col("temp")).alias("temp"))
    return rounded(stats.corr_matrix(rows, ["temp", "humidity"]), "r")


@query
def rolling_events(spark, d):
    """Three-hour means over single events, whose times have fractions of a second."""
    events = materialize(spark.read.parquet(f"{d}/events.parquet").select(
        "event_id", F.concat(F.lit("city_"), (F.col("user_id") % 3).cast("string")).alias("city"), "ts", "value"))
    return _both_modes(lambda split: rounded(
        tsop.rolling_mean(events, ["value"], by="time", split=split), "value_rolling_3h"))


@query
def payload_report(spark, d):
    """Payloads per city: accepted and rejected ones, and the rows and temperatures of the former.

    Every fifth day's payload is cut short, one day a week answers with an error, and one hour
    in eleven reads NaN."""
    hours = fx.weather_hourly(spark, d).withColumn(
        "temp", F.when(F.hour("ts") % 11 == 2, F.lit(float("nan"))).otherwise(F.col("temp")))
    good = _daily_payloads(hours, schemas.WEATHER_FIELDS, {}, absent="")
    text = F.when(F.col("n") % 5 == 0, F.expr("left(payload, length(payload) - 9)")).when(
        F.col("n") % 7 == 3, F.lit('{"error": true}')).otherwise(F.col("payload"))
    numbered = good.withColumn("n", F.dayofmonth(F.left(F.get_json_object("payload", "$.hourly.time[0]"), F.lit(10)).cast("date")))
    accepted, rejected = feeds.split_payloads(
        materialize(numbered.select("city", text.alias("payload"))), "payload", schemas.WEATHER_FIELDS)
    rows = feeds.decode_text(accepted, "payload", schemas.WEATHER_FIELDS)
    counts = accepted.withColumn("good", F.lit(1)).unionByName(rejected.withColumn("good", F.lit(0)))
    counts = counts.groupBy("city").agg(F.sum("good").alias("accepted"), F.sum(1 - F.col("good")).alias("rejected"))
    return counts.join(rows.groupBy("city").agg(F.count("*").alias("hours"), F.count("temp").alias("temps")), "city")


@query
def upsert_without_time(spark, d):
    """Two upserts whose rows partly lack a time: none of them loses rows of the other."""
    out = Table(spark, _work_path(spark, "raw"), monthly=True)
    hour = F.when(F.hour("ts") % 6 != 0, F.col("ts"))
    rows = materialize(fx.raw_weather(spark, d).groupBy("city", hour.alias("ts")).agg(F.max("clouds").alias("clouds")))
    for city in ("city_0", "city_1", "city_2"):
        out.upsert(rows.filter(F.col("city") == city))
    return out.read()


@query
def stored_lookup(spark, d):
    """Rows of a stored table by value and by time; both filters reach the scan."""
    out = Table(spark, _work_path(spark, "raw"), monthly=True)
    out.overwrite(fx.raw_weather(spark, d))
    wanted = out.lookup(source=schemas.SOURCE_FORECAST, city="city_1").select("city", "ts", "temp", "source")
    recent = out.read(since=fx.at("2024-01-20 00:00:00"), until=fx.at("2024-01-20 06:00:00"))
    return wanted.unionByName(recent.select("city", "ts", "temp", "source"))
