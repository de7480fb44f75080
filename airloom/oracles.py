"""DuckDB SQL for the registered queries, written independently of the Spark plans."""

from __future__ import annotations

from airloom.schemas import (
    AQI_CATEGORIES, AQI_LAGS, AQI_MEASURES, OUTLIER_COLUMNS, PM25_BREAKPOINTS,
    REGISTERED_FEATURES, WEATHER_MEASURES,
)
from airloom.report_cells import ANALYSED, PAGES

MEASURES = (*WEATHER_MEASURES, *AQI_MEASURES)


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _mean(kind: str) -> str:
    return (f"CAST(sum(CASE WHEN event_type='{kind}' THEN v END) AS DOUBLE)"
            f" / nullif(count(CASE WHEN event_type='{kind}' THEN 1 END), 0)")


VIEWS = {
    "readings": """SELECT concat('city_', CAST(user_id % 3 AS VARCHAR)) AS city,
        CAST(date_trunc('hour', ts) AS TIMESTAMP) AS ts, event_type,
        CAST(value AS DECIMAL(18,2)) AS v, CAST(json_extract_string(props, '$.k') AS INT) AS k FROM events""",
    "weather_hourly": f"""SELECT city, ts, {_mean('click')} AS temp, {_mean('view')} AS humidity,
        1000.0 + CAST(sum(k) AS DOUBLE) / count(k) / 10 AS pressure,
        {_mean('purchase')} AS wind_speed, CAST(max(k) AS DOUBLE) AS clouds
        FROM readings WHERE event_type IN ('click','view','purchase') GROUP BY city, ts""",
    "weather_feed": """SELECT city, ts, temp, humidity, pressure, wind_speed, clouds,
        'open-meteo-archive' AS source, 1 AS seq FROM weather_hourly WHERE ts < TIMESTAMP '2024-01-28 00:00:00'
        UNION ALL SELECT city, ts, temp + 0.5, humidity, pressure, wind_speed, clouds,
        'open-meteo-forecast' AS source, 2 AS seq FROM weather_hourly WHERE ts >= TIMESTAMP '2024-01-27 00:00:00'""",
    "raw_weather": """SELECT city, ts, temp, humidity, pressure, wind_speed, clouds, source FROM (
        SELECT *, row_number() OVER (PARTITION BY city, ts ORDER BY seq DESC) AS rn FROM weather_feed) q
        WHERE rn = 1""",
    "raw_aqi": f"""SELECT city, ts, {_mean('error')} AS pm10, {_mean('signup')} AS pm2_5,
        CAST(max(k) * 10 AS DOUBLE) AS carbon_monoxide, CAST(min(k) AS DOUBLE) AS nitrogen_dioxide,
        CAST(count(*) AS DOUBLE) AS sulphur_dioxide, CAST(sum(k) AS DOUBLE) AS ozone,
        CASE WHEN extract(hour FROM ts) % 5 = 0 THEN NULL ELSE CAST(sum(v) AS DOUBLE) / count(v) END AS us_aqi,
        CAST(sum(v) AS DOUBLE) / count(v) * 0.6 AS european_aqi
        FROM readings WHERE event_type IN ('error','signup') AND ts < TIMESTAMP '2024-01-28 00:00:00'
        GROUP BY city, ts""",
    "joined": """SELECT w.city, w.ts, temp, humidity, pressure, wind_speed, clouds, source, pm10, pm2_5,
        carbon_monoxide, nitrogen_dioxide, sulphur_dioxide, ozone, us_aqi, european_aqi
        FROM raw_weather w JOIN raw_aqi a ON w.city = a.city AND w.ts = a.ts""",
    "forecast": """SELECT * FROM raw_weather
        WHERE source = 'open-meteo-forecast' AND ts >= TIMESTAMP '2024-01-28 00:00:00'""",
}
_DEPENDS = {
    "readings": [], "weather_hourly": ["readings"], "weather_feed": ["weather_hourly"],
    "raw_weather": ["weather_feed"], "raw_aqi": ["readings"], "joined": ["raw_weather", "raw_aqi"],
    "forecast": ["raw_weather"], "preds": ["forecast"], "daily": [], "quality": ["raw_aqi"],
}


def _case(value: str, field: int) -> str:
    arms = " ".join(f"WHEN {value} <= {row[0]} THEN {_text(row[field])}"
                    for row in AQI_CATEGORIES if row[0] is not None)
    return f"CASE WHEN {value} IS NULL THEN NULL {arms} ELSE {_text(AQI_CATEGORIES[-1][field])} END"


def _pm25(value: str) -> str:
    arms = " ".join(
        f"WHEN {value} BETWEEN {cl}::DOUBLE AND {ch}::DOUBLE THEN "
        f"{ih - il}::DOUBLE / ({ch}::DOUBLE - {cl}::DOUBLE) * ({value} - {cl}::DOUBLE) + {il}"
        for cl, ch, il, ih in PM25_BREAKPOINTS)
    return f"CASE {arms} END"


VIEWS["preds"] = f"""SELECT *, {_case('predicted_aqi', 1)} AS aqi_category FROM (
    SELECT city, ts, temp, humidity, pressure, wind_speed, clouds,
      coalesce(temp, 0) + 0.5::DOUBLE * coalesce(humidity, 0) + 0.25::DOUBLE * coalesce(wind_speed, 0)
        AS predicted_aqi, 'Gradient Boosting' AS model_name FROM forecast) f"""
VIEWS["daily"] = """SELECT concat('city_', CAST(l_suppkey AS VARCHAR)) AS city,
    CAST(l_shipdate AS TIMESTAMP) AS ts,
    CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS temp,
    CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) / count(*) / 210 AS pm2_5,
    CAST(sum(CAST(l_discount AS DECIMAL(18,2))) AS DOUBLE) * 100 AS humidity,
    CASE WHEN sum(l_linenumber) % 5 = 0 THEN NULL
         ELSE CAST(sum(CAST(l_tax AS DECIMAL(18,2))) AS DOUBLE) / count(*) * 1000 END AS us_aqi
    FROM lineitem GROUP BY l_suppkey, l_shipdate"""

_QUALITY_STEPS = f"""SELECT model_name, is_train, count(*) AS n,
    1 - sum((predicted-actual)*(predicted-actual)) / nullif(var_pop(actual) * count(actual), 0) AS r2,
    avg(abs(predicted-actual)) AS mae, sqrt(avg((predicted-actual)*(predicted-actual))) AS rmse
  FROM (SELECT g.city, g.ts, g.actual, g.is_train, m.model_name,
      CASE m.model_name WHEN 'Persistence' THEN g.persistence WHEN 'Particles' THEN g.particles
        ELSE g.scaled END AS predicted
    FROM (SELECT city, ts, actual,
        coalesce(lag(actual) OVER w, 0) AS persistence,
        coalesce(pm10, 0) * 0.5::DOUBLE + coalesce(pm2_5, 0) * 0.5::DOUBLE AS particles,
        european_aqi * 1.5::DOUBLE AS scaled,
        row_number() OVER w <= floor(count(*) OVER (PARTITION BY city) * 0.8::DOUBLE) AS is_train
      FROM (SELECT *, coalesce(us_aqi, {_pm25('pm2_5')}) AS actual FROM raw_aqi) a
      WHERE actual IS NOT NULL WINDOW w AS (PARTITION BY city ORDER BY ts)) g
    CROSS JOIN (VALUES ('Persistence'), ('Particles'), ('Scaled')) m(model_name)) p
  GROUP BY model_name, is_train"""
VIEWS["quality"] = _QUALITY_STEPS


def with_views(body: str, *views: str, extra: dict[str, str] | None = None) -> str:
    """Prefix a query with the views it needs, in dependency order."""
    ordered: list[str] = []

    def need(name: str) -> None:
        for d in _DEPENDS[name]:
            need(d)
        if name not in ordered:
            ordered.append(name)

    for v in views:
        need(v)
    parts = [f"{v} AS ({VIEWS[v]})" for v in ordered]
    parts += [f"{n} AS ({sql})" for n, sql in (extra or {}).items()]
    return f"WITH {', '.join(parts)} {body}" if parts else body


_PAST = "OVER (PARTITION BY city ORDER BY ts ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
_FUTURE = "OVER (PARTITION BY city ORDER BY ts ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)"


def _ffill(c: str) -> str:
    return f"last_value({c} IGNORE NULLS) {_PAST}"


def _bfill(c: str) -> str:
    return f"first_value({c} IGNORE NULLS) {_FUTURE}"


def _fill2(source: str, columns, keep: str) -> tuple[str, str]:
    """Forward then backward fill as two nested selects."""
    once = f"SELECT {keep}, {', '.join(f'{_ffill(c)} AS {c}' for c in columns)} FROM {source}"
    return once, f"SELECT {keep}, {', '.join(f'{_bfill(c)} AS {c}' for c in columns)} FROM ({once}) f1"


def _zscore(source: str, columns, keep: str) -> str:
    sql = f"SELECT *, count(*) OVER (PARTITION BY city) AS n0 FROM ({source}) z"
    for c in columns:
        sql = (f"SELECT *, avg({c}) OVER (PARTITION BY city) AS m, "
               f"stddev_samp({c}) OVER (PARTITION BY city) AS s FROM ({sql}) z")
        sql = (f"SELECT *, CASE WHEN n0 >= 50 AND s IS NOT NULL AND s <> 0 "
               f"THEN coalesce(abs(({c} - m) / s) < 3, false) END AS fit FROM ({sql}) z")
        sql = (f"SELECT *, avg(CASE WHEN fit THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END) "
               f"OVER (PARTITION BY city) AS share FROM ({sql}) z")
        sql = f"SELECT {keep}, n0 FROM ({sql}) z WHERE fit IS NULL OR share < 0.8 OR fit"
    return f"SELECT {keep} FROM ({sql}) z"


def _calendar(ts: str = "ts") -> str:
    return f"""CAST(extract(hour FROM {ts}) AS INT) AS hour, CAST(extract(day FROM {ts}) AS INT) AS day,
      CAST(extract(month FROM {ts}) AS INT) AS month, CAST(isodow({ts}) - 1 AS INT) AS day_of_week,
      CAST(CASE WHEN isodow({ts}) >= 6 THEN 1 ELSE 0 END AS INT) AS is_weekend,
      CAST(CASE WHEN extract(hour FROM {ts}) BETWEEN 7 AND 9 OR extract(hour FROM {ts}) BETWEEN 17 AND 19
        THEN 1 ELSE 0 END AS INT) AS is_rush_hour"""


def _mean3(c: str) -> str:
    return f"avg({c}) OVER (PARTITION BY city ORDER BY ts ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)"


def _corr(a: str, b: str) -> str:
    r = f"corr({a}, {b})"
    return f"round(CASE WHEN isnan({r}) THEN NULL ELSE {r} END, 6)"


def _profile(columns: dict[str, bool], source: str, group: str = "") -> str:
    """One UNION ALL branch per column; the flag says whether it is numeric."""
    branches = []
    for c, numeric in columns.items():
        numbers = (f"round(avg({c}), 6) AS mean, round(stddev_samp({c}), 6) AS std, round(min({c}), 6) AS min, "
                   f"round(max({c}), 6) AS max, round(median({c}), 6) AS median" if numeric else
                   "NULL::DOUBLE AS mean, NULL::DOUBLE AS std, NULL::DOUBLE AS min, NULL::DOUBLE AS max, "
                   "NULL::DOUBLE AS median")
        lead = f"{group}, " if group else ""
        tail = f" GROUP BY {group}" if group else ""
        branches.append(f"SELECT {lead}'{c}' AS feature_name, count(*) AS count, "
                        f"count(*) - count({c}) AS null_count, {numbers} FROM {source}{tail}")
    return " UNION ALL ".join(branches)


def _histogram(source: str, column: str, bins: int) -> str:
    return f"""SELECT bin, round(lo + bin * w, 6) AS bin_low, round(lo + (bin + 1) * w, 6) AS bin_high, n FROM (
      SELECT CAST(least(floor(({column} - lo) / w), {bins - 1}) AS INT) AS bin, any_value(lo) AS lo,
        any_value(w) AS w, count(*) AS n
      FROM (SELECT {column}, lo, (hi - lo) / {bins} AS w FROM {source},
        (SELECT min({column}) AS lo, max({column}) AS hi FROM {source}) r WHERE {column} IS NOT NULL) x
      GROUP BY 1) y"""


def _box(columns, source: str) -> str:
    return " UNION ALL ".join(f"""SELECT '{c}' AS column_name, round(q1, 6) AS q25, round(q2, 6) AS q50,
      round(q3, 6) AS q75,
      round(min(CASE WHEN {c} BETWEEN q1-1.5::DOUBLE*(q3-q1) AND q3+1.5::DOUBLE*(q3-q1) THEN {c} END), 6) AS whisker_low,
      round(max(CASE WHEN {c} BETWEEN q1-1.5::DOUBLE*(q3-q1) AND q3+1.5::DOUBLE*(q3-q1) THEN {c} END), 6) AS whisker_high,
      count(CASE WHEN NOT ({c} BETWEEN q1-1.5::DOUBLE*(q3-q1) AND q3+1.5::DOUBLE*(q3-q1)) THEN 1 END) AS outliers
      FROM {source}, (SELECT quantile_cont({c}, 0.25) AS q1, quantile_cont({c}, 0.5) AS q2,
        quantile_cont({c}, 0.75) AS q3 FROM {source}) q GROUP BY q1, q2, q3""" for c in columns)


_FORECAST_FILL = ["temp", "humidity", "pressure", "wind_speed", "clouds",
                  "temp_humidity_interaction", "wind_pressure_interaction", "temp_rolling_3h"]
_LAG_NAMES = [f"aqi_lag_{k}" for k in AQI_LAGS]


def _forecast_views() -> dict[str, str]:
    scalars = f"""SELECT f.*, {_calendar()}, temp * humidity AS temp_humidity_interaction,
        wind_speed * pressure AS wind_pressure_interaction, 0.0::DOUBLE AS pm2_5_rolling_3h,
        {_mean3('temp')} AS temp_rolling_3h FROM forecast f"""
    lags = ", ".join(f"coalesce(recent, 50.0::DOUBLE) AS {n}" for n in _LAG_NAMES)
    lagged = f"""SELECT s.*, {lags} FROM ({scalars}) s LEFT JOIN (
        SELECT city, us_aqi AS recent FROM (SELECT *, row_number() OVER (PARTITION BY city ORDER BY ts DESC) AS rn
          FROM raw_aqi) q WHERE rn = 1) a ON s.city = a.city"""
    others = ", ".join(["city", "ts", "source", "hour", "day", "month", "day_of_week", "is_weekend",
                        "is_rush_hour", "pm2_5_rolling_3h", *_LAG_NAMES])
    _, both = _fill2(f"({lagged}) l", _FORECAST_FILL, others)
    zeroed = f"SELECT {others}, {', '.join(f'coalesce({c}, 0) AS {c}' for c in _FORECAST_FILL)} FROM ({both}) b"
    return {"features": zeroed}


def _lags(source: str, by_time: bool = False) -> str:
    if not by_time:
        cols = ", ".join(f"lag(us_aqi, {k}) OVER w AS aqi_lag_{k}" for k in AQI_LAGS)
        return f"SELECT city, ts, us_aqi, {cols} FROM {source} WINDOW w AS (PARTITION BY city ORDER BY ts)"
    cols = ", ".join(f"l{k}.us_aqi AS aqi_lag_{k}" for k in AQI_LAGS)
    hops = " ".join(f"LEFT JOIN {source} l{k} ON l{k}.city = j.city AND l{k}.ts = j.ts - INTERVAL {k} HOUR"
                    for k in AQI_LAGS)
    return f"SELECT j.city, j.ts, j.us_aqi, {cols} FROM {source} j {hops}"


def _rolling_time(c: str) -> str:
    return (f"round(avg({c}) OVER (PARTITION BY city ORDER BY ts RANGE BETWEEN INTERVAL 2 HOUR PRECEDING "
            f"AND CURRENT ROW), 6) AS {c}_rolling_3h")


def _preprocess() -> str:
    keep = "city, ts"
    indexed = (f"SELECT city, ts, {', '.join(m for m in MEASURES if m != 'us_aqi')}, "
               f"coalesce(us_aqi, {_pm25('pm2_5')}) AS us_aqi FROM joined")
    _, filled = _fill2(f"({indexed}) i", MEASURES, keep)
    screened = _zscore(filled, OUTLIER_COLUMNS, ", ".join([keep, *MEASURES]))
    plain = ", ".join(m for m in MEASURES if m != "us_aqi")
    return f"""SELECT city, ts, {plain}, round(us_aqi, 6) AS us_aqi, {_calendar()},
      temp * humidity AS temp_humidity_interaction, wind_speed * pressure AS wind_pressure_interaction,
      round({_mean3('pm2_5')}, 6) AS pm2_5_rolling_3h, round({_mean3('temp')}, 6) AS temp_rolling_3h
      FROM ({screened}) s"""


def _wide_quality(digits: int = 6) -> str:
    cols = ", ".join(
        f'round(max(CASE WHEN {"" if part == "Train" else "NOT "}is_train THEN {kind.lower()} END), {digits}) '
        f'AS "{kind} ({part})"' for kind in ("R2", "MAE", "RMSE") for part in ("Train", "Test"))
    return f'SELECT model_name AS "Model", {cols} FROM quality GROUP BY model_name'


def _pages(q: dict[str, str]) -> dict[str, str]:
    """Report pages out of the SQL of their frames."""
    def view(body: str, *names: str) -> str:
        return with_views(body, *names)

    analysed = "joined"
    describe = " UNION ALL ".join(
        f"""SELECT '{c}' AS column_name, count({c}) AS count, avg({c}) AS mean, stddev_samp({c}) AS std, min({c}) AS min,
            quantile_cont({c}, 0.25) AS q25, quantile_cont({c}, 0.5) AS q50, quantile_cont({c}, 0.75) AS q75, max({c}) AS max FROM {analysed}"""
        for c in ANALYSED)
    melted = {kind: f"""SELECT model_name AS "Model", '{kind} (' || CASE WHEN is_train THEN 'Train' ELSE 'Test' END || ')' AS "Dataset",
                        {kind.lower()} AS value FROM quality""" for kind in ("R2", "MAE", "RMSE")}
    categories = ", ".join(f"({_text(row[1])}, {_text(row[3])}, {_text(row[2])})" for row in AQI_CATEGORIES)
    recent = f"SELECT city, ts, us_aqi FROM (SELECT *, row_number() OVER ({_TOP[0]}) AS rn FROM raw_aqi) x WHERE rn <= 20"
    frames = {
        "page_overview": {
            "counts": view("""SELECT 'raw_aqi' AS table_name, count(*) AS n FROM raw_aqi UNION ALL SELECT 'feature_store', count(*) FROM joined
                UNION ALL SELECT 'model_registry', count(DISTINCT model_name) FROM quality""", "joined", "quality"),
            "latest": q["latest_aqi"], "last_week": q["last_168"]},
        "page_data_analysis": {
            "shape": q["shape_report"], "describe": view(describe, "joined"), "missing": q["missing_report"],
            "aqi_stats": view("""SELECT count(*) AS n, min(ts) AS first_ts, max(ts) AS last_ts, avg(us_aqi) AS mean, median(us_aqi) AS median,
                stddev_samp(us_aqi) AS std, min(us_aqi) AS min, max(us_aqi) AS max FROM joined""", "joined"),
            "correlation": view(" UNION ALL ".join(
                f"SELECT '{a}' AS col_a, '{b}' AS col_b, " + ("1.0 AS r" if a == b else f"{_corr(a, b)} AS r FROM joined")
                for a in ANALYSED for b in ANALYSED), "joined"),
            "correlation_with_aqi": view(" UNION ALL ".join(
                f"SELECT '{a}' AS column_name, {_corr(a, 'us_aqi')} AS r FROM joined" for a in ANALYSED), "joined"),
            "boxes": view(_box(OUTLIER_COLUMNS, "joined"), "joined"),
            **{f"histogram_{c}": view(_histogram("joined", c, 50), "joined") for c in ("pm2_5", "temp")},
            "series": view("SELECT ts, us_aqi, temp, humidity, pm2_5, pm10 FROM joined", "joined")},
        "page_model_performance": {"comparison": q["model_comparison"], **{k: view(sql, "quality") for k, sql in melted.items()}},
        "page_current_prediction": {
            "current": view(f"""SELECT city, ts, predicted_aqi, {_case('predicted_aqi', 1)} AS category, {_case('predicted_aqi', 2)} AS color FROM (
                SELECT *, row_number() OVER (PARTITION BY city ORDER BY abs(epoch_us(ts) - epoch_us(TIMESTAMP '2024-01-28 05:20:00')), ts) AS rn
                FROM preds) x WHERE rn = 1""", "preds"),
            "first_24": view(f"SELECT city, ts, predicted_aqi FROM (SELECT *, row_number() OVER ({_TOP[1]}) AS rn FROM preds) x WHERE rn <= 24", "preds")},
        "page_forecast": {
            "headline": view("""SELECT p.city, avg(predicted_aqi) AS avg_aqi, max(predicted_aqi) AS max_aqi, min(predicted_aqi) AS min_aqi, any_value(c.aqi_category) AS most_common
                FROM preds p JOIN (SELECT city, aqi_category, row_number() OVER (PARTITION BY city ORDER BY count(*) DESC, aqi_category) AS rn
                  FROM preds GROUP BY city, aqi_category) c ON c.city = p.city AND c.rn = 1 GROUP BY p.city""", "preds"),
            "daily": q["daily_summary"], "hourly": q["hourly_format"], "histogram": q["hist_predicted"],
            "category_share": view("""SELECT city, aqi_category, n, n / CAST(sum(n) OVER (PARTITION BY city) AS DOUBLE) AS share FROM (
                SELECT city, aqi_category, count(*) AS n FROM preds GROUP BY ALL) c""", "preds"),
            "temperature": view("""SELECT city, count(*) AS n, min(ts) AS first_ts, max(ts) AS last_ts, avg(temp) AS mean, min(temp) AS min, max(temp) AS max
                FROM preds GROUP BY city""", "preds"),
            "advice": view(f"""SELECT city, ts, predicted_aqi, {_case('predicted_aqi', 1)} AS category, {_case('predicted_aqi', 3)} AS zone,
                {_case('predicted_aqi', 4)} AS advice FROM preds""", "preds"),
            "categories": f"SELECT * FROM (VALUES {categories}) c(category, zone, color)"},
        "page_accuracy": {
            "recent": view(recent, "raw_aqi"), "trend": q["recent_trend"], "models": q["model_status"], "errors": q["error_rows"],
            "error_summary": f"""SELECT city, avg(abs_error) AS mae, sqrt(avg(abs_error * abs_error)) AS rmse FROM (
                SELECT city, abs(predicted - actual) AS abs_error FROM ({q["error_rows"]}) e) x GROUP BY city"""},
    }
    pages = {}
    for page, spec in PAGES.items():
        cells = []
        for frame, (ids, columns) in spec.items():
            name = "concat_ws('|', " + ", ".join(f'CAST("{c}" AS VARCHAR)' for c in ids) + ")" if ids else "''"
            for c in columns:
                value, label = ("NULL::DOUBLE", f'CAST("{c[1:]}" AS VARCHAR)') if c.startswith("=") else (f'round(CAST("{c}" AS DOUBLE), 6)', "NULL::VARCHAR")
                cells.append(f"SELECT '{frame}' AS frame, {name} AS id, '{c.lstrip('=')}' AS name, {value} AS value, {label} AS label FROM ({frames[page][frame]}) t")
        pages[page] = " UNION ALL ".join(cells)
    return pages


def _stumps(rounds: int) -> str:
    """Rounds of depth 1 with the library's penalties: L1 and L2 of 1, a least gain of 0.5, five rows a side."""
    features = ("hour", "clouds", "carbon_monoxide", "nitrogen_dioxide")

    def shrunk(g: str) -> str:
        return f"(sign({g}) * greatest(abs({g}) - 1, 0))"

    def score(g: str, n: str) -> str:
        return f"({shrunk(g)} ** 2 / ({n} + 1))"

    extra = {
        "src": f"""SELECT row_number() OVER () AS rid, * FROM (SELECT extract(hour FROM ts)::DOUBLE AS hour, clouds, carbon_monoxide,
            nitrogen_dioxide, us_aqi FROM joined) j WHERE {' AND '.join(f'{c} IS NOT NULL' for c in (*features, 'us_aqi'))}""",
        "long": " UNION ALL ".join(f"SELECT rid, {i} AS f, '{c}' AS feature, {c} AS v FROM src" for i, c in enumerate(features)),
        "margin0": "SELECT rid, us_aqi AS y, avg(us_aqi) OVER () AS m FROM src",
    }
    for r in range(1, rounds + 1):
        extra[f"cuts{r}"] = f"""SELECT f, feature, v, sum(g) OVER up AS gl, sum(n) OVER up AS nl, sum(g) OVER (PARTITION BY f) AS gt, sum(n) OVER (PARTITION BY f) AS nt
            FROM (SELECT f, feature, v, sum(m - y) AS g, count(*) AS n FROM long JOIN margin{r - 1} USING (rid) GROUP BY ALL) s WINDOW up AS (PARTITION BY f ORDER BY v)"""
        extra[f"best{r}"] = f"""SELECT {r} AS round, feature, v AS cut, gain, -0.3::DOUBLE * {shrunk('gl')} / (nl + 1) AS left_value,
            -0.3::DOUBLE * {shrunk('(gt - gl)')} / (nt - nl + 1) AS right_value FROM (
              SELECT *, {score('gl', 'nl')} + {score('(gt - gl)', '(nt - nl)')} - {score('gt', 'nt')} AS gain FROM cuts{r}) c
            WHERE nl >= 5 AND nt - nl >= 5 AND gain > 0.5 ORDER BY round(gain, 6) DESC, f, v LIMIT 1"""
        extra[f"margin{r}"] = f"""SELECT p.rid, p.y, p.m + CASE WHEN l.v <= b.cut THEN b.left_value ELSE b.right_value END AS m
            FROM margin{r - 1} p JOIN best{r} b ON true JOIN long l ON l.rid = p.rid AND l.feature = b.feature"""
    return with_views(" UNION ALL ".join(
        f"SELECT CAST(round AS INT) AS round, feature, cut, round(gain, 3) AS gain, round(left_value, 6) AS left_value, "
        f"round(right_value, 6) AS right_value FROM best{r}" for r in range(1, rounds + 1)), "joined", extra=extra)


def _forward_zero(columns) -> str:
    return ", ".join(f"coalesce({c}, 0) AS {c}" for c in columns)


_TOP = ("PARTITION BY city ORDER BY ts DESC", "PARTITION BY city ORDER BY ts")
_CORR = ["temp", "humidity", "pressure", "pm2_5", "us_aqi", "lat"]
_CORR_SRC = {"src": "SELECT temp, humidity, pressure, pm2_5, us_aqi, 27.7058::DOUBLE AS lat FROM joined"}
_FEATURE_VALUES = ", ".join("(" + ", ".join(_text(x) for x in row) + ")" for row in REGISTERED_FEATURES)
_FLAGS = {"temp": True, "humidity": True, "pressure": True, "pm2_5": True, "us_aqi": True, "source": False}


#: The columns that the models are trained on, in their order.
_MODEL_FEATURES = (
    "temp", "humidity", "pressure", "wind_speed", "clouds", "carbon_monoxide", "nitrogen_dioxide", "sulphur_dioxide",
    "ozone", "hour", "day", "month", "day_of_week", "is_weekend", "is_rush_hour", "temp_humidity_interaction",
    "wind_pressure_interaction", "pm2_5_rolling_3h", "temp_rolling_3h", "aqi_lag_1", "aqi_lag_3", "aqi_lag_6",
    "aqi_lag_12", "aqi_lag_24", "aqi_lag_48",
)


def oracle_sql() -> dict[str, str]:
    q: dict[str, str] = {}
    m = ", ".join(MEASURES)

    # sources
    q["columnar_json"] = with_views(
        """SELECT city, ts, temp, CASE WHEN i <= 12 THEN humidity END AS humidity, pressure, wind_speed,
           CASE WHEN extract(day FROM ts) % 2 = 1 THEN clouds END AS clouds
           FROM (SELECT *, row_number() OVER (PARTITION BY city, CAST(ts AS DATE) ORDER BY ts) AS i
                 FROM weather_hourly) x""", "weather_hourly")
    def payload_rows(source, cut, absent, names):
        arms = [f"CASE WHEN i <= {cut[n]} THEN {n} END AS {n}" if n in cut else
                f"CASE WHEN extract(day FROM ts) % 2 = 1 THEN {n} END AS {n}" if n == absent else n
                for n in names]
        return f"""SELECT city, ts, {', '.join(arms)} FROM (SELECT *, row_number() OVER (
            PARTITION BY city, CAST(ts AS DATE) ORDER BY ts) AS i FROM {source}) x"""
    place = "27.7::DOUBLE AS lat, 68.9::DOUBLE AS lon"
    q["weather_files"] = with_views(
        f"SELECT *, {place}, 'open-meteo-forecast' AS source FROM ("
        + payload_rows("weather_hourly", {"humidity": 12}, "clouds", WEATHER_MEASURES) + ") p", "weather_hourly")
    q["aqi_files"] = with_views(
        f"SELECT *, {place}, 'open-meteo-archive' AS source FROM ("
        + payload_rows("raw_aqi", {"pm10": 5, "ozone": 20}, "us_aqi", AQI_MEASURES) + ") p", "raw_aqi")
    q["time_coercion"] = """SELECT event_id, CASE WHEN event_id % 7 <> 0
        THEN CAST(date_trunc('second', ts) AS TIMESTAMP) END AS ts FROM events"""
    q["rounding"] = "SELECT event_id, round_even(value, 1) AS value FROM events"
    q["last_events"] = "SELECT event_id, ts, value FROM events ORDER BY ts DESC, event_id LIMIT 20"
    q["weather_upsert"] = with_views("SELECT * FROM raw_weather", "raw_weather")
    q["feed_ingest"] = q["weather_upsert"]
    q["trailing_window"] = with_views(
        """SELECT city, ts, temp FROM raw_weather WHERE ts >= TIMESTAMP '2024-01-11 00:00:00'
           AND ts < TIMESTAMP '2024-01-25 00:00:00'""", "raw_weather")
    q["source_filter"] = with_views(
        "SELECT city, ts, temp FROM raw_weather WHERE source = 'open-meteo-forecast'", "raw_weather")
    q["table_counts"] = with_views(
        " UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS n FROM {t}"
                           for t in ("raw_weather", "raw_aqi", "joined")), "joined")
    names = ", ".join(["city", "ts", *MEASURES])
    q["shape_report"] = with_views(
        f"""SELECT count(*) AS row_count, {len(MEASURES) + 2}::BIGINT AS column_count,
            '{names}' AS column_names, min(ts) AS first_ts, max(ts) AS last_ts FROM joined""", "joined")

    # scalar expressions
    q["pm25_to_aqi"] = f"SELECT event_id, round({_pm25('value')}, 6) AS aqi FROM events"
    dim = ", ".join(f"({a}::DOUBLE, {b}::DOUBLE, {c}, {e})" for a, b, c, e in PM25_BREAKPOINTS)
    q["pm25_to_aqi_range_join"] = f"""SELECT event_id,
        round((ih - il) / (ch - cl) * (value - cl) + il, 6) AS aqi
        FROM events LEFT JOIN (VALUES {dim}) d(cl, ch, il, ih) ON value BETWEEN cl AND ch"""
    q["aqi_category"] = (f"SELECT event_id, {_case('value', 1)} AS category, {_case('value', 2)} AS color "
                         "FROM events")
    q["category_lookup"] = (f"SELECT event_id, {_case('value', 1)} AS category, {_case('value', 3)} AS zone, "
                            f"{_case('value', 4)} AS advice FROM events")
    q["us_aqi_filled"] = with_views(
        f"SELECT city, ts, round(coalesce(us_aqi, {_pm25('pm2_5')}), 6) AS us_aqi FROM raw_aqi", "raw_aqi")
    q["calendar_features"] = f"SELECT event_id, {_calendar()} FROM events"
    q["interactions"] = with_views(
        """SELECT city, ts, temp * humidity AS temp_humidity_interaction,
           wind_speed * pressure AS wind_pressure_interaction FROM raw_weather""", "raw_weather")
    q["hourly_format"] = with_views(
        """SELECT city, strftime(ts, '%Y-%m-%d %H:00') AS hour_label, round(predicted_aqi, 6) AS predicted_aqi,
           aqi_category AS category FROM preds""", "preds")
    q["today_rows"] = with_views(
        "SELECT city, ts, temp, humidity FROM raw_weather WHERE CAST(ts AS DATE) = DATE '2024-01-27'",
        "raw_weather")
    some = ["city", "ts", "temp", "humidity", "wind_speed", "pm10", "pm2_5", "us_aqi"]
    present = " + ".join(f"CASE WHEN {c} IS NULL THEN 0 ELSE 1 END" for c in some)
    q["drop_sparse_rows"] = with_views(f"SELECT {', '.join(some)} FROM joined WHERE {present} >= 4", "joined")
    q["drop_any_null"] = with_views(
        f"SELECT city, ts, {m} FROM joined WHERE {' AND '.join(f'{c} IS NOT NULL' for c in MEASURES)}", "joined")

    # joins
    q["weather_aqi_join"] = with_views("SELECT * FROM joined", "joined")
    q["join_suffixes"] = with_views(
        """SELECT city, ts, temp, pm2_5, 27.7058::DOUBLE AS lat_weather, 68.8574::DOUBLE AS lon_weather,
           27.7058::DOUBLE AS lat_aqi, 68.8574::DOUBLE AS lon_aqi FROM joined""", "joined")
    q["semi_recent_actuals"] = with_views(
        f"""SELECT city, ts, us_aqi FROM raw_aqi a WHERE (city, ts) IN (SELECT (city, ts) FROM (
            SELECT city, ts, row_number() OVER ({_TOP[0]}) AS rn FROM joined) r WHERE rn <= 24)""", "joined")
    q["nearest_reading"] = with_views(
        """SELECT city, ts, temp, humidity, source FROM (SELECT *, row_number() OVER (PARTITION BY city
           ORDER BY abs(epoch_us(ts) - epoch_us(TIMESTAMP '2024-01-15 10:00:00')), ts) AS rn
           FROM raw_weather) x WHERE rn = 1""", "raw_weather")
    q["nearest_join"] = with_views(
        """SELECT event_id, near_ts, near_pressure FROM (
             SELECT event_id, w.ts AS near_ts, w.pressure AS near_pressure, row_number() OVER (
               PARTITION BY event_id ORDER BY abs(epoch_us(w.ts) - epoch_us(e.ts)), w.ts) AS rn
             FROM events e LEFT JOIN raw_weather w
               ON w.city = concat('city_', CAST(e.user_id % 3 AS VARCHAR))) x WHERE rn = 1""", "raw_weather")
    q["nearest_join_tolerance"] = with_views(
        """SELECT city, ts, near_ts, near_us_aqi FROM (
             SELECT d.city, d.ts, k.ts AS near_ts, k.us_aqi AS near_us_aqi, row_number() OVER (
               PARTITION BY d.city, d.ts ORDER BY abs(epoch_us(k.ts) - epoch_us(d.ts)), k.ts) AS rn
             FROM daily d LEFT JOIN daily k ON k.city = d.city AND k.us_aqi IS NOT NULL
               AND k.ts BETWEEN d.ts - INTERVAL 2 DAY AND d.ts + INTERVAL 2 DAY) x WHERE rn = 1""", "daily")

    # fills and windows
    for name, fn in (("ffill", _ffill), ("bfill", _bfill)):
        cols = ", ".join(f"{fn(c)} AS {c}" for c in ("temp", "pm2_5", "us_aqi"))
        q[name] = with_views(f"SELECT city, ts, {cols} FROM joined", "joined")
    q["fill_chain"] = with_views(_fill2("joined", MEASURES, "city, ts")[1], "joined")
    gap = {"gap": "SELECT city, ts, temp, CASE WHEN city <> 'city_1' THEN pm2_5 END AS pm2_5 FROM joined"}
    gap["filled"] = _fill2("gap", ["temp", "pm2_5"], "city, ts")[1]
    q["fill_median_fallback"] = with_views(
        """SELECT city, ts, coalesce(temp, (SELECT median(temp) FROM filled)) AS temp,
           coalesce(pm2_5, (SELECT median(pm2_5) FROM filled)) AS pm2_5 FROM filled""", "joined", extra=gap)
    gap = {"gap": "SELECT city, ts, CASE WHEN city <> 'city_2' THEN temp END AS temp, humidity FROM raw_weather"}
    gap["filled"] = _fill2("gap", ["temp", "humidity"], "city, ts")[1]
    q["forecast_fill_zero"] = with_views(
        f"SELECT city, ts, {_forward_zero(['temp', 'humidity'])} FROM filled", "raw_weather", extra=gap)
    keep = ", ".join(["city", "ts", *OUTLIER_COLUMNS])
    q["zscore_filter"] = with_views(
        _zscore(f"SELECT city, ts, {_forward_zero(OUTLIER_COLUMNS)} FROM joined", OUTLIER_COLUMNS, keep), "joined")
    series = ["temp", "pm2_5", "humidity", "us_aqi"]
    q["zscore_many_series"] = with_views(
        _zscore(f"SELECT city, ts, {_forward_zero(series)} FROM daily", ["pm2_5", "temp", "humidity"],
                ", ".join(["city", "ts", *series])), "daily")
    q["rolling3_rows"] = with_views(
        f"""SELECT city, ts, pm2_5, temp, round({_mean3('pm2_5')}, 6) AS pm2_5_rolling_3h,
            round({_mean3('temp')}, 6) AS temp_rolling_3h FROM joined""", "joined")
    q["rolling3_time"] = with_views(
        f"SELECT city, ts, pm2_5, temp, {_rolling_time('pm2_5')}, {_rolling_time('temp')} FROM joined", "joined")
    q["aqi_lags"] = with_views(_lags("joined"), "joined")
    q["aqi_lags_many_series"] = with_views(_lags("daily"), "daily")
    q["aqi_lags_time"] = with_views(_lags("joined", by_time=True), "joined")
    q["sequence_windows"] = with_views(
        """SELECT city, ts, CAST(steps AS INT) AS steps, first_pressure, last_pressure,
             round(sum_ozone, 6) AS sum_ozone, target FROM (
             SELECT city, ts, count(*) OVER w AS steps, first_value(pressure) OVER w AS first_pressure,
               last_value(pressure) OVER w AS last_pressure, sum(ozone) OVER w AS sum_ozone, us_aqi AS target
             FROM joined WINDOW w AS (PARTITION BY city ORDER BY ts ROWS BETWEEN 24 PRECEDING AND 1 PRECEDING)) x
           WHERE steps = 24""", "joined")
    ranked = """SELECT city, ts, row_number() OVER (PARTITION BY city ORDER BY ts) - 1 AS p,
                count(*) OVER (PARTITION BY city) AS n FROM daily"""
    q["chrono_split"] = with_views(
        f"SELECT city, ts, p < floor(n * 0.8::DOUBLE) AS is_train FROM ({ranked}) r", "daily")
    q["cv_folds"] = with_views(
        f"""SELECT city, ts, CAST(CASE WHEN n // 6 = 0 OR p < n - 5 * (n // 6) THEN 0
            ELSE (p - (n - 5 * (n // 6))) // (n // 6) + 1 END AS INT) AS fold FROM ({ranked}) r""", "daily")
    q["row_positions"] = with_views(f"SELECT city, ts, p AS position, n FROM ({ranked}) r", "daily")
    q["latest_aqi"] = with_views(
        f"""SELECT city, ts, us_aqi, {_case('us_aqi', 1)} AS category, {_case('us_aqi', 2)} AS color
            FROM (SELECT *, row_number() OVER ({_TOP[0]}) AS rn FROM raw_aqi) x WHERE rn = 1""", "raw_aqi")
    q["last_168"] = with_views(
        f"""SELECT city, ts, us_aqi FROM (SELECT *, row_number() OVER ({_TOP[0]}) AS rn FROM raw_aqi) x
            WHERE rn <= 168""", "raw_aqi")
    q["first_24_forecast"] = with_views(
        f"""SELECT city, ts, aqi_category FROM (SELECT *, row_number() OVER ({_TOP[1]}) AS rn FROM preds) x
            WHERE rn <= 24""", "preds")
    q["forecast_144"] = with_views(
        f"""SELECT city, ts, temp, humidity, pressure, wind_speed, clouds, source FROM (
            SELECT *, row_number() OVER ({_TOP[1]}) AS rn FROM forecast) x WHERE rn <= 144""", "forecast")

    # forecast features and preparation
    shown = ["city", "ts", "temp", "humidity", "pressure", "wind_speed", "hour", "day", "month", "day_of_week",
             "is_weekend", "is_rush_hour", "pm2_5_rolling_3h", *_LAG_NAMES, "temp_humidity_interaction",
             "wind_pressure_interaction"]
    q["forecast_features"] = with_views(
        f"SELECT {', '.join(shown)}, round(temp_rolling_3h, 6) AS temp_rolling_3h FROM features",
        "forecast", "raw_aqi", extra=_forecast_views())
    q["feature_align"] = with_views(
        """SELECT city, ts, coalesce(wind_speed, 0) AS wind_speed, 0.0::DOUBLE AS lat_weather,
           coalesce(temp, 0) AS temp, coalesce(humidity, 0) AS humidity, coalesce(clouds, 0) AS clouds,
           round(coalesce(temp_rolling_3h, 0), 6) AS temp_rolling_3h FROM features""",
        "forecast", "raw_aqi", extra=_forecast_views())
    q["preprocess"] = with_views(_preprocess(), "joined")

    # aggregates
    def daily_sql(value, source):
        return f"""SELECT city, day, avg_aqi, min_aqi, max_aqi, {_case('avg_aqi', 1)} AS category FROM (
          SELECT city, CAST(ts AS DATE) AS day, round_even(avg({value}), 1) AS avg_aqi,
            round_even(min({value}), 1) AS min_aqi, round_even(max({value}), 1) AS max_aqi
          FROM {source} GROUP BY 1, 2) s"""
    q["daily_summary"] = with_views(daily_sql("predicted_aqi", "preds"), "preds")
    q["daily_summary_filled"] = with_views(
        daily_sql(f"coalesce(us_aqi, {_pm25('pm2_5')})", "joined"), "joined")
    q["forecast_summary"] = with_views(
        """SELECT city, count(*) AS n, min(ts) AS first_ts, max(ts) AS last_ts, round(avg(predicted_aqi), 6) AS mean,
           round(min(predicted_aqi), 6) AS min, round(max(predicted_aqi), 6) AS max FROM preds GROUP BY city""", "preds")
    q["headline_metrics"] = with_views(
        """SELECT round(avg(predicted_aqi), 6) AS avg_aqi, round(max(predicted_aqi), 6) AS max_aqi,
             round(min(predicted_aqi), 6) AS min_aqi, (SELECT aqi_category FROM preds GROUP BY 1
               ORDER BY count(*) DESC, aqi_category LIMIT 1) AS most_common FROM preds""", "preds")
    q["category_counts"] = with_views(
        "SELECT city, aqi_category, count(*) AS n FROM preds GROUP BY 1, 2", "preds")
    q["category_share"] = with_views(
        """SELECT aqi_category, n, round(n / CAST(sum(n) OVER () AS DOUBLE), 6) AS share FROM (
           SELECT aqi_category, count(*) AS n FROM preds GROUP BY 1) c""", "preds")
    q["temp_summary"] = with_views(
        "SELECT round(avg(temp), 6) AS mean, round(min(temp), 6) AS min, round(max(temp), 6) AS max FROM preds",
        "preds")
    q["feature_profile"] = with_views(_profile({"city": False, **_FLAGS}, "joined"), "joined")
    q["feature_profile_by_city"] = with_views(
        _profile({"temp": True, "us_aqi": True}, "joined", "city"), "joined")
    q["describe"] = with_views(" UNION ALL ".join(
        f"""SELECT '{c}' AS column_name, count({c}) AS count, round(avg({c}), 6) AS mean,
            round(stddev_samp({c}), 6) AS std, round(min({c}), 6) AS min,
            round(quantile_cont({c}, 0.25), 6) AS q25, round(quantile_cont({c}, 0.5), 6) AS q50,
            round(quantile_cont({c}, 0.75), 6) AS q75, round(max({c}), 6) AS max FROM daily"""
        for c in ("temp", "pm2_5", "humidity", "us_aqi")), "daily")
    q["missing_report"] = with_views(
        "SELECT column_name, missing, round(missing / CAST(n AS DOUBLE) * 100, 6) AS pct FROM ("
        + " UNION ALL ".join(f"SELECT '{c}' AS column_name, count(*) - count({c}) AS missing, count(*) AS n "
                             "FROM joined" for c in ("city", "ts", *MEASURES))
        + ") x WHERE missing > 0", "joined")
    q["aqi_stats"] = with_views(
        """SELECT count(*) AS n, min(ts) AS first_ts, max(ts) AS last_ts, round(avg(us_aqi), 6) AS mean,
           round(median(us_aqi), 6) AS median, round(stddev_samp(us_aqi), 6) AS std,
           round(min(us_aqi), 6) AS min, round(max(us_aqi), 6) AS max FROM raw_aqi""", "raw_aqi")
    q["event_quantiles"] = """SELECT event_type, round(quantile_cont(value, 0.25), 6) AS q25,
        round(quantile_cont(value, 0.5), 6) AS q50, round(quantile_cont(value, 0.75), 6) AS q75
        FROM events GROUP BY event_type"""
    q["median_imputation"] = with_views(
        """SELECT city, round(median(temp), 6) AS temp, round(median(pm2_5), 6) AS pm2_5
           FROM joined GROUP BY city""", "joined")
    q["recent_trend"] = with_views(
        f"""SELECT city, round(mean, 6) AS mean, round(std, 6) AS std, round(lo, 6) AS min, round(hi, 6) AS max,
            round(latest, 6) AS latest, round(mean24, 6) AS mean_recent,
            CASE WHEN latest > mean24 THEN 'UP' ELSE 'DOWN' END AS trend FROM (
            SELECT city, avg(us_aqi) AS mean, stddev_samp(us_aqi) AS std, min(us_aqi) AS lo, max(us_aqi) AS hi,
              max(CASE WHEN rn = 1 THEN us_aqi END) AS latest,
              avg(CASE WHEN rn <= 24 THEN us_aqi END) AS mean24
            FROM (SELECT *, row_number() OVER ({_TOP[0]}) AS rn FROM raw_aqi) x WHERE rn <= 168 GROUP BY city) y""",
        "raw_aqi")
    q["hist_pm25"] = with_views(_histogram("joined", "pm2_5", 50), "joined")
    q["hist_predicted"] = with_views(_histogram("preds", "predicted_aqi", 30), "preds")
    q["box_summary"] = with_views(_box(OUTLIER_COLUMNS, "joined"), "joined")
    q["corr_matrix"] = with_views(" UNION ALL ".join(
        f"SELECT '{a}' AS col_a, '{b}' AS col_b, {_corr(a, b)} AS r FROM src" for a in _CORR for b in _CORR),
        "joined", extra=_CORR_SRC)
    q["corr_target"] = with_views(" UNION ALL ".join(
        f"SELECT '{a}' AS column_name, {_corr(a, 'us_aqi')} AS r FROM src" for a in _CORR),
        "joined", extra=_CORR_SRC)

    # model quality
    q["error_rows"] = with_views(
        """SELECT city, ts, predicted, actual, round(abs(predicted - actual), 6) AS abs_error,
           round(CASE WHEN actual > 0 THEN abs(predicted - actual) / actual * 100 ELSE 0 END, 6) AS error_pct
           FROM (SELECT w.city, w.ts, coalesce(temp, 0) AS predicted, us_aqi AS actual FROM raw_weather w
             JOIN raw_aqi a ON w.city = a.city AND w.ts = a.ts WHERE us_aqi IS NOT NULL) x""",
        "raw_weather", "raw_aqi")
    q["regression_metrics"] = with_views(
        """SELECT model_name, is_train, n, round(r2, 6) AS r2, round(mae, 6) AS mae, round(rmse, 6) AS rmse
           FROM quality""", "quality")
    q["model_comparison"] = with_views(_wide_quality(), "quality")
    q["comparison_file"] = q["model_comparison"]
    q["model_melt"] = with_views(
        """SELECT model_name AS "Model", CASE WHEN is_train THEN 'R2 (Train)' ELSE 'R2 (Test)' END AS "Dataset",
           round(r2, 6) AS value FROM quality""", "quality")
    q["best_model"] = with_views(
        """SELECT model_name, round(r2, 6) AS r2_test FROM quality WHERE NOT is_train
           ORDER BY r2 DESC, model_name LIMIT 1""", "quality")
    q["model_status"] = with_views(
        """SELECT model_name, round(r2, 6) AS r2_test, round(mae, 6) AS mae_test, round(rmse, 6) AS rmse_test,
           CASE WHEN r2 > 0.7 THEN 'Good' ELSE 'Needs improvement' END AS status FROM quality
           WHERE NOT is_train""", "quality")
    q["metadata_merge"] = with_views(
        f"""SELECT coalesce(p.feature_name, f.feature_name) AS feature_name, description, data_type, f.source AS source,
            count, null_count, mean, median
            FROM (VALUES {_FEATURE_VALUES}) f(feature_name, description, data_type, source)
            FULL OUTER JOIN ({_profile({'city': False, **_FLAGS}, 'joined')}) p
              ON f.feature_name = p.feature_name""", "joined")

    q["feature_store"] = q["metadata_merge"]

    # Spark ML: what holds for any model
    lags = ", ".join(f"lag(us_aqi, {k}) OVER w AS aqi_lag_{k}" for k in AQI_LAGS)
    plain = f"""SELECT count(*) AS test_rows, round(sqrt(avg((us_aqi - mean) ** 2)), 4) AS rmse_mean,
          round(sqrt(avg((us_aqi - aqi_lag_1) ** 2)), 4) AS rmse_persistence
        FROM (SELECT *, avg(us_aqi) FILTER (is_train) OVER () AS mean FROM (
          SELECT *, row_number() OVER (PARTITION BY city ORDER BY ts) - 1 < floor(count(*) OVER (PARTITION BY city) * 0.8) AS is_train
          FROM (SELECT *, {lags} FROM ({_preprocess()}) p WINDOW w AS (PARTITION BY city ORDER BY ts)) l
          WHERE {' AND '.join(f'{c} IS NOT NULL' for c in (*MEASURES, *_LAG_NAMES))}) m) t WHERE NOT is_train"""
    q["train_compare"] = with_views(f"""SELECT m.*, true AS beats_mean, true AS beats_persistence, b.*
        FROM (VALUES ('Random Forest', true, 2::BIGINT), ('XGBoost', true, 2::BIGINT),
          ('Gradient Boosting', true, 2::BIGINT)) m("Model", metrics_match, parts), ({plain}) b""", "joined")
    q["regularised_boosting"] = _stumps(3)
    q["score_forecast"] = with_views(
        """SELECT city, ts, humidity, hour, true AS scored, true AS category_fits, true AS is_best FROM features""",
        "forecast", "raw_aqi", extra=_forecast_views())
    q["backtest"] = with_views(
        f"""SELECT f.city, f.ts, us_aqi AS actual, true AS error_fits FROM (
              SELECT city, ts, row_number() OVER (PARTITION BY city ORDER BY ts DESC) AS rn FROM ({_preprocess()}) p) f
            JOIN raw_aqi a ON a.city = f.city AND a.ts = f.ts WHERE rn <= 24""", "joined")
    numbered = ", ".join(f"({i + 1}, '{n}')" for i, n in enumerate(_MODEL_FEATURES))
    q["feature_importance"] = f"""SELECT feature_name, 1.0::DOUBLE AS total, true AS is_share
        FROM (VALUES {numbered}) f(number, feature_name)"""
    q["registered_features"] = f"SELECT CAST(number AS INT) AS number, feature_name FROM (VALUES {numbered}) f(number, feature_name)"
    q["pipeline_forecast"] = with_views(
        """SELECT city, CAST(ts AS DATE) AS day, count(*) AS hours, true AS mean_fits, true AS category_fits
           FROM features GROUP BY 1, 2""", "forecast", "raw_aqi", extra=_forecast_views())

    q["global_order"] = """SELECT event_id, event_type, CAST(value AS DOUBLE) AS value,
        row_number() OVER (ORDER BY value DESC, event_id) AS rank FROM events"""
    q["grouped_describe"] = " UNION ALL ".join(
        f"""SELECT event_type, '{c}' AS column_name, count({c}) AS count, round(avg({c}), 6) AS mean, round(stddev_samp({c}), 6) AS std,
            round(min({c})::DOUBLE, 6) AS min, round(quantile_cont({c}::DOUBLE, 0.25), 6) AS q25, round(quantile_cont({c}::DOUBLE, 0.5), 6) AS q50,
            round(quantile_cont({c}::DOUBLE, 0.75), 6) AS q75, round(max({c})::DOUBLE, 6) AS max FROM events GROUP BY event_type"""
        for c in ("value", "user_id"))
    q.update(_pages(q))
    q["feature_stage"] = q["feature_store"]
    counts = {"raw_weather": "raw_weather", "raw_aqi": "raw_aqi", "preprocessed": f"({_preprocess()})", "features": f"({_preprocess()})",
              "models": "(VALUES (1), (2), (3))", "predictions": "ahead", "scored": "ahead",
              "days": "(SELECT DISTINCT city, CAST(ts AS DATE) FROM ahead)"}
    ahead = {"ahead": """SELECT city, ts FROM (SELECT *, row_number() OVER (PARTITION BY city ORDER BY ts) AS rn FROM forecast) f WHERE rn <= 144"""}
    q["end_to_end"] = with_views(
        "SELECT c.*, run FROM (" + " UNION ALL ".join(f"SELECT '{name}' AS table_name, count(*) AS n FROM {rows} t" for name, rows in counts.items())
        + ") c, (VALUES (1), (2)) r(run)", "joined", "forecast", extra=ahead)
    q["fallback_source"] = with_views(
        """SELECT city, ts, temp, us_aqi, false AS prepared FROM joined
           UNION ALL SELECT city, ts, 1.0::DOUBLE, us_aqi, true FROM joined WHERE us_aqi IS NOT NULL""", "joined")
    q["drop_missing_target"] = with_views(
        "SELECT city, ts, temp, us_aqi FROM joined WHERE us_aqi IS NOT NULL AND clouds % 5 <> 0", "joined")
    scaled = ", ".join(f"round(({c} - m_{c}) / s_{c}, 6) AS {c}" for c in ("temp", "humidity", "ozone"))
    moments = ", ".join(f"avg({c}) AS m_{c}, stddev_samp({c}) AS s_{c}" for c in ("temp", "humidity", "ozone"))
    q["scaled_features"] = with_views(
        f"""SELECT city, ts, {scaled} FROM known, (SELECT {moments} FROM known WHERE ts < TIMESTAMP '2024-01-15 00:00:00') m
            WHERE ts >= TIMESTAMP '2024-01-15 00:00:00'""", "joined",
        extra={"known": "SELECT city, ts, temp, humidity, ozone FROM joined WHERE temp IS NOT NULL AND humidity IS NOT NULL AND ozone IS NOT NULL"})

    # tables as a whole
    q["failed_writes"] = with_views(
        """SELECT step, 2 AS failures, CAST(extract(year FROM ts) AS INT) AS year, count(*) AS n,
            sum(temp + CASE WHEN step = 'upserted' AND extract(year FROM ts) = 1995 AND extract(month FROM ts) <= 6 THEN 1 ELSE 0 END) AS total
            FROM daily, (VALUES ('kept'), ('upserted')) s(step) GROUP BY ALL""", "daily")
    q["series_lengths"] = with_views(
        "SELECT city, CAST(count(*) AS BIGINT) AS rows, min(ts) AS first, max(ts) AS last FROM raw_weather GROUP BY city", "raw_weather")
    q["stored_fill"] = with_views(
        f"""SELECT city, ts, {_ffill('temp')} AS temp, {_ffill('wind_speed')} AS wind_speed,
            round(avg(humidity) OVER (PARTITION BY city ORDER BY ts ROWS 2 PRECEDING), 6) AS humidity_rolling_3h FROM raw_weather""", "raw_weather")

    # streaming, against the batch result; late events do not count
    q["stream_hourly"] = """SELECT concat('city_', CAST(user_id % 3 AS VARCHAR)) AS city,
        CAST(date_trunc('hour', ts) AS TIMESTAMP) AS ts, count(*) AS n,
        CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total,
        CAST(min(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS low,
        CAST(max(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS high FROM events
        WHERE NOT (event_id % 50 = 0 AND extract(day FROM ts) <= 10) GROUP BY 1, 2"""
    landed = """SELECT event_id, concat('city_', CAST(user_id % 3 AS VARCHAR)) AS city, ts, CAST(value AS DECIMAL(18,2)) AS value,
        CASE WHEN event_id % 50 = 0 AND extract(day FROM ts) <= 10 THEN 4 ELSE least((extract(day FROM ts) - 1) // 6, 4) END AS landing FROM events"""
    marks = """SELECT l.landing, (SELECT max(ts) FROM landed e WHERE e.landing < l.landing) AS newest
        FROM (SELECT DISTINCT landing FROM landed) l"""
    q["stream_hourly_late"] = f"""WITH landed AS ({landed}), marks AS ({marks}),
        told AS (SELECT city, CAST(date_trunc('hour', ts) AS TIMESTAMP) AS hour, value,
          coalesce(date_trunc('hour', ts) + INTERVAL 1 HOUR <= newest - INTERVAL 1 HOUR, false) AS late FROM landed JOIN marks USING (landing))
        SELECT city, hour AS ts, count(*) FILTER (NOT late) AS n, CAST(sum(value) FILTER (NOT late) AS DOUBLE) AS total,
          count(*) FILTER (late) AS late FROM told GROUP BY 1, 2"""
    q["first_arrivals"] = f"""WITH once AS ({landed}),
        landed AS (SELECT *, true AS first FROM once UNION ALL
          SELECT event_id, city, ts, value + 1000, landing + 1, false FROM once WHERE event_id % 7 = 0 AND landing < 4),
        marks AS ({marks}),
        told AS (SELECT landed.*, coalesce(ts < newest - INTERVAL 2 DAY, false) AS late FROM landed JOIN marks USING (landing))
        SELECT event_id, city, ts, CAST(value AS DOUBLE) AS value, (SELECT count(*) FROM told WHERE late) AS late
        FROM told WHERE first AND NOT late"""
    q["stream_upsert"] = q["weather_upsert"]
    q["stream_first_by_key"] = """SELECT concat('city_', CAST(user_id % 3 AS VARCHAR)) AS city,
        CAST(date_trunc('hour', ts) AS TIMESTAMP) AS hour_ts,
        coalesce(min(event_id) FILTER (NOT (event_id % 50 = 0 AND extract(day FROM ts) <= 10)), min(event_id)) AS event_id
        FROM events GROUP BY 1, 2"""

    # NULL keys, NaN, broken payloads, short instants
    nameless = "(SELECT nullif(city, 'city_0') AS city, ts, temp, humidity FROM raw_weather)"
    modes = "(VALUES (false), (true)) m(split)"
    q["null_key_series"] = with_views(
        f"""SELECT city, ts, temp, humidity, humidity_rolling_3h, lag(temp, 1) OVER s AS lag_1, lag(temp, 3) OVER s AS lag_3,
            row_number() OVER s - 1 AS position, split
            FROM (SELECT city, ts, last_value(temp IGNORE NULLS) OVER (PARTITION BY city ORDER BY ts) AS temp, humidity,
              round(avg(humidity) OVER (PARTITION BY city ORDER BY ts ROWS 2 PRECEDING), 6) AS humidity_rolling_3h
              FROM {nameless}) f, {modes} WINDOW s AS (PARTITION BY city, split ORDER BY ts)""", "raw_weather")
    q["null_key_nearest"] = with_views(
        f"""SELECT event_id, nullif(city, 'city_0') AS city, near_ts, near_humidity, split FROM (
             SELECT event_id, e.city, w.ts AS near_ts, w.humidity AS near_humidity, row_number() OVER (
               PARTITION BY event_id ORDER BY abs(epoch_us(w.ts) - epoch_us(e.ts)), w.ts) AS rn
             FROM (SELECT *, concat('city_', CAST(user_id % 3 AS VARCHAR)) AS city FROM events) e
             LEFT JOIN raw_weather w ON w.city = e.city) x, {modes} WHERE rn = 1""", "raw_weather")
    q["null_key_last_known"] = with_views(
        """SELECT nullif(w.city, 'city_0') AS city, w.ts, coalesce(us_aqi, 50.0::DOUBLE) AS recent, coalesce(us_aqi, 50.0::DOUBLE) AS again
           FROM raw_weather w LEFT JOIN (SELECT city, arg_max_null(us_aqi, ts) AS us_aqi FROM raw_aqi WHERE city <> 'city_1' GROUP BY city) k
             ON k.city = w.city WHERE w.ts >= TIMESTAMP '2024-01-28 00:00:00'""", "raw_weather", "raw_aqi")
    q["null_key_marks"] = with_views(
        f"""SELECT city, ts, pos < floor(n * 0.8) AS is_train, true AS all_of_it,
            CASE WHEN n // 6 = 0 THEN 0 ELSE CAST(greatest(0, 6 - ceil((n - pos) / (n // 6)::DOUBLE)) AS INT) END AS fold, split
            FROM (SELECT city, ts, row_number() OVER (PARTITION BY city ORDER BY ts) - 1 AS pos,
              count(*) OVER (PARTITION BY city) AS n FROM {nameless}) r, {modes}""", "raw_weather")
    parts = " UNION ALL ".join(
        f"""SELECT city, '{c}' AS feature_name, count(*) AS count, count(*) - count(v) AS null_count, round(avg(v), 6) AS mean,
            round(min(v), 6) AS min, round(max(v), 6) AS max, round(quantile_cont(v, 0.5), 6) AS median
            FROM (SELECT city, {value} AS v FROM {nameless}) x GROUP BY city"""
        for c, value in (("temp", "CASE WHEN extract(hour FROM ts) % 7 = 3 THEN NULL ELSE temp END"), ("humidity", "humidity")))
    q["null_key_profile"] = with_views(parts, "raw_weather")

    def screened(rows: str, column: str) -> str:
        return f"""SELECT * EXCLUDE (z_ok, seen, spread) FROM (
            SELECT *, avg(CASE WHEN z_ok THEN 1.0 ELSE 0 END) OVER (PARTITION BY city) AS seen FROM (
              SELECT *, coalesce(abs(({column} - avg({column}) OVER (PARTITION BY city))
                / nullif(stddev_samp({column}) OVER (PARTITION BY city), 0)) < 3, false) AS z_ok,
                CASE WHEN n >= 50 THEN stddev_samp({column}) OVER (PARTITION BY city) END AS spread
              FROM (SELECT * EXCLUDE n, count(*) OVER (PARTITION BY city) AS n FROM (SELECT *, 0 AS n FROM {rows}))))
            WHERE z_ok OR spread IS NULL OR spread = 0 OR seen < 0.8"""

    filled = f"(SELECT city, ts, coalesce(temp, 0) AS temp, coalesce(humidity, 0) AS humidity FROM {nameless})"
    once = screened(filled, "temp")
    twice = screened(f"(SELECT city, ts, temp, humidity FROM ({once}))", "humidity")
    q["null_key_zscore"] = with_views(f"SELECT city, ts, temp, humidity FROM ({twice})", "raw_weather")
    q["quantiles_odd_values"] = """SELECT event_type, round(quantile_cont(v, 0.25), 6) AS q25, round(quantile_cont(v, 0.5), 6) AS q50,
        round(quantile_cont(v, 0.75), 6) AS q75, searched FROM (
          SELECT event_type, CASE WHEN event_id % 11 = 0 THEN NULL WHEN event_id % 101 = 0 THEN 'Infinity'::DOUBLE
            WHEN event_id % 103 = 0 THEN '-Infinity'::DOUBLE ELSE value END AS v FROM events) e,
        (VALUES (false), (true)) m(searched) GROUP BY event_type, searched"""
    q["corr_with_nan"] = with_views(
        """SELECT a AS col_a, b AS col_b, CASE WHEN a = b THEN 1.0 ELSE r END AS r FROM (
            SELECT round(corr(CASE WHEN extract(hour FROM ts) % 5 = 1 THEN NULL ELSE temp END, humidity), 6) AS r FROM raw_weather) c,
            (VALUES ('temp', 'temp'), ('temp', 'humidity'), ('humidity', 'temp'), ('humidity', 'humidity')) p(a, b)""", "raw_weather")
    q["rolling_events"] = f"""SELECT event_id, city, ts, value, round(avg(value) OVER (PARTITION BY city, split ORDER BY ts
        RANGE BETWEEN INTERVAL 2 HOURS PRECEDING AND CURRENT ROW), 6) AS value_rolling_3h, split
        FROM (SELECT event_id, concat('city_', CAST(user_id % 3 AS VARCHAR)) AS city, ts, value FROM events) e, {modes}"""
    q["payload_report"] = with_views(
        """SELECT city, count(DISTINCT day) FILTER (ok) AS accepted, count(DISTINCT day) FILTER (NOT ok) AS rejected,
            count(*) FILTER (ok) AS hours, count(temp) FILTER (ok AND extract(hour FROM ts) % 11 <> 2) AS temps
            FROM (SELECT *, CAST(ts AS DATE) AS day, NOT (extract(day FROM ts) % 5 = 0 OR extract(day FROM ts) % 7 = 3) AS ok
              FROM weather_hourly) h GROUP BY city""", "weather_hourly")
    q["upsert_without_time"] = with_views(
        """SELECT city, CASE WHEN extract(hour FROM ts) % 6 <> 0 THEN ts END AS ts, max(clouds) AS clouds
           FROM raw_weather GROUP BY 1, 2""", "raw_weather")
    q["stored_lookup"] = with_views(
        """SELECT city, ts, temp, source FROM raw_weather WHERE source = 'open-meteo-forecast' AND city = 'city_1'
           UNION ALL SELECT city, ts, temp, source FROM raw_weather
           WHERE ts >= TIMESTAMP '2024-01-20 00:00:00' AND ts < TIMESTAMP '2024-01-20 06:00:00'""", "raw_weather")
    return q
