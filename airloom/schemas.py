"""Table schemas and the fixed dimension values every stage shares."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

KEYS = ("city",)
ORDER = "ts"

SOURCE_ARCHIVE = "open-meteo-archive"
SOURCE_FORECAST = "open-meteo-forecast"

WEATHER_MEASURES = ("temp", "humidity", "pressure", "wind_speed", "clouds")
AQI_MEASURES = (
    "pm10", "pm2_5", "carbon_monoxide", "nitrogen_dioxide",
    "sulphur_dioxide", "ozone", "us_aqi", "european_aqi",
)


def _schema(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, dtype, True) for name, dtype in fields])


def _reading_schema(measures: tuple[str, ...]) -> T.StructType:
    return _schema(
        ("city", T.StringType()),
        ("lat", T.DoubleType()),
        ("lon", T.DoubleType()),
        ("ts", T.TimestampNTZType()),
        *[(m, T.DoubleType()) for m in measures],
        ("source", T.StringType()),
        ("fetched_at", T.TimestampType()),
    )


RAW_WEATHER = _reading_schema(WEATHER_MEASURES)
RAW_AQI = _reading_schema(AQI_MEASURES)

STATISTICS = _schema(
    ("count", T.LongType()), ("null_count", T.LongType()),
    ("mean", T.DoubleType()), ("std", T.DoubleType()),
    ("min", T.DoubleType()), ("max", T.DoubleType()), ("median", T.DoubleType()),
    ("timestamp", T.TimestampType()),
)
FEATURE_METADATA = _schema(
    ("feature_name", T.StringType()), ("description", T.StringType()),
    ("data_type", T.StringType()), ("source", T.StringType()),
    ("created_at", T.TimestampType()), ("updated_at", T.TimestampType()),
    ("statistics", STATISTICS),
)
MODEL_REGISTRY = _schema(
    ("model_name", T.StringType()), ("model_path", T.StringType()),
    ("metrics", T.MapType(T.StringType(), T.DoubleType())),
    ("feature_names", T.ArrayType(T.StringType())),
    ("hyperparameters", T.MapType(T.StringType(), T.StringType())),
    ("registered_at", T.TimestampType()), ("status", T.StringType()),
)
MODEL_COMPARISON = _schema(
    ("Model", T.StringType()),
    ("R2 (Train)", T.DoubleType()), ("R2 (Test)", T.DoubleType()),
    ("MAE (Train)", T.DoubleType()), ("MAE (Test)", T.DoubleType()),
    ("RMSE (Train)", T.DoubleType()), ("RMSE (Test)", T.DoubleType()),
)

# Wire names of the hourly arrays in the weather payload -> column of raw_weather.
WEATHER_FIELDS = {
    "temperature_2m": "temp",
    "relative_humidity_2m": "humidity",
    "pressure_msl": "pressure",
    "wind_speed_10m": "wind_speed",
    "cloud_cover": "clouds",
}
# The pollutant payload already uses the column names of raw_aqi.
AQI_FIELDS = {name: name for name in AQI_MEASURES}


def payload_schema(fields: dict[str, str]) -> T.StructType:
    """Schema of one columnar JSON payload: parallel hourly arrays plus its coordinates."""
    hourly = _schema(
        ("time", T.ArrayType(T.StringType())),
        *[(wire, T.ArrayType(T.DoubleType())) for wire in fields],
    )
    return _schema(
        ("latitude", T.DoubleType()), ("longitude", T.DoubleType()), ("hourly", hourly)
    )


# PM2.5 concentration interval -> index interval.
PM25_BREAKPOINTS = [
    (0.0, 12.0, 0, 50),
    (12.1, 35.4, 51, 100),
    (35.5, 55.4, 101, 150),
    (55.5, 150.4, 151, 200),
    (150.5, 250.4, 201, 300),
    (250.5, 350.4, 301, 400),
    (350.5, 500.4, 401, 500),
]

# Upper bound (inclusive; None = open), category, chart colour, zone, advice.
AQI_CATEGORIES = [
    (50.0, "Good", "#00E400", "0-50",
     "Air quality is satisfactory, and air pollution poses little or no risk."),
    (100.0, "Moderate", "#FFFF00", "51-100",
     "Air quality is acceptable; however, there may be a risk for some people."),
    (150.0, "Unhealthy for Sensitive Groups", "#FF7E00", "101-150",
     "Members of sensitive groups may experience health effects."),
    (200.0, "Unhealthy", "#FF0000", "151-200",
     "Everyone may begin to experience health effects; sensitive groups at greater risk."),
    (300.0, "Very Unhealthy", "#8F3F97", "201-300",
     "Health alert: everyone may experience more serious health effects."),
    (None, "Hazardous", "#7E0023", "301+",
     "Health warnings of emergency conditions; entire population is likely to be affected."),
]

# The registered features (name, description, data type, source).
REGISTERED_FEATURES = [
    ("pm2_5", "PM2.5 concentration", "float", "open-meteo"),
    ("pm10", "PM10 concentration", "float", "open-meteo"),
    ("us_aqi", "US AQI index", "float", "open-meteo"),
    ("temp", "Temperature in Celsius", "float", "openweather"),
    ("humidity", "Humidity percentage", "float", "openweather"),
    ("pressure", "Atmospheric pressure", "float", "openweather"),
    ("wind_speed", "Wind speed", "float", "openweather"),
    ("temp_humidity_interaction", "Temperature-Humidity interaction", "float", "derived"),
    ("wind_pressure_interaction", "Wind-Pressure interaction", "float", "derived"),
]

# Columns screened by the z-score filter, in screening order.
OUTLIER_COLUMNS = ("pm2_5", "pm10", "temp", "humidity", "pressure", "wind_speed")

# Lags of the target, in rows.
AQI_LAGS = (1, 3, 6, 12, 24, 48)

# Columns that never become model features (the target is excluded as well).
NON_FEATURES = (
    "ts", "city", "lat", "lon", "fetched_at", "weather_main", "weather_description",
    "source_weather", "source_aqi", "pm2_5", "pm10", "european_aqi",
)

RUSH_HOURS = (7, 8, 9, 17, 18, 19)


def _values(spark: SparkSession, rows: Sequence[Sequence], columns: str) -> DataFrame:
    """Fixed rows as an inline table: no job, and a size the planner knows."""
    def literal(v) -> str:
        return f"double('{v!r}')" if isinstance(v, float) else "'" + str(v).replace("'", "\\'") + "'"

    body = ", ".join("(" + ", ".join(map(literal, row)) + ")" for row in rows)
    return spark.sql(f"SELECT * FROM VALUES {body} AS t({columns})")


def breakpoint_dim(spark: SparkSession) -> DataFrame:
    """PM2.5 breakpoints as a seven-row table."""
    rows = [tuple(map(float, row)) for row in PM25_BREAKPOINTS]
    return _values(spark, rows, "c_low, c_high, i_low, i_high")


def category_dim(spark: SparkSession) -> DataFrame:
    """Index categories as a six-row table; a category covers ``low < value <= high``."""
    tops = [float("inf") if row[0] is None else row[0] for row in AQI_CATEGORIES]
    lows = [float("-inf"), *tops]
    rows = [(low, top, *row[1:]) for low, top, row in zip(lows, tops, AQI_CATEGORIES)]
    return _values(spark, rows, "low, high, category, color, zone, advice")


def feature_dim(spark: SparkSession) -> DataFrame:
    """Descriptions of the nine registered features."""
    return _values(spark, REGISTERED_FEATURES, "feature_name, description, data_type, source")
