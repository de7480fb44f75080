"""Small frames and pandas counterparts shared by the tests."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import functions as F


def gappy(seed: int = 0, cities=("a", "b", "c"), hours: int = 400, nulls: float = 0.4) -> pd.DataFrame:
    """Hourly series with missing rows, long holes and missing values."""
    rng = np.random.default_rng(seed)
    frames = []
    for i, city in enumerate(cities):
        ts = pd.date_range("2024-01-01", periods=hours, freq="h")
        keep = rng.random(hours) > 0.3
        keep[hours // 3: hours // 2] &= rng.random(hours // 2 - hours // 3) > 0.9
        n = int(keep.sum())
        frame = pd.DataFrame({"city": city, "ts": ts[keep]})
        for c in ("x", "y"):
            values = rng.normal(10 * (i + 1), 5, n).round(3)
            values[rng.random(n) < nulls] = np.nan
            frame[c] = values
        frames.append(frame)
    return pd.concat(frames, ignore_index=True)


def to_spark(spark, pdf: pd.DataFrame):
    """pandas frame as a Spark frame with NTZ times and NULL instead of NaN."""
    df = spark.createDataFrame(pdf)
    out = []
    for f in df.schema:
        c = F.col(f.name)
        if f.dataType.typeName() in ("timestamp", "timestamp_ntz"):
            c = c.cast("timestamp_ntz")
        elif f.dataType.typeName() == "double":
            c = F.nanvl(c, F.lit(None).cast("double"))
        out.append(c.alias(f.name))
    return df.select(*out)


def rows(df, *columns):
    """Rows as sorted tuples."""
    columns = columns or df.columns
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr)


def same(a, b, tolerance=1e-9) -> bool:
    if a is None or b is None or (isinstance(a, float) and math.isnan(a)):
        missing = [v is None or (isinstance(v, float) and math.isnan(v)) for v in (a, b)]
        return all(missing)
    if isinstance(a, float) or isinstance(b, float):
        return math.isclose(a, b, rel_tol=tolerance, abs_tol=tolerance)
    return a == b


def assert_equals_pandas(df, expected: pd.DataFrame, columns, keys=("city", "ts")):
    got = df.select(*keys, *columns).toPandas().sort_values(list(keys)).reset_index(drop=True)
    want = expected[[*keys, *columns]].sort_values(list(keys)).reset_index(drop=True)
    assert len(got) == len(want)
    for k in keys:
        assert list(got[k]) == list(want[k])
    for c in columns:
        for a, b in zip(got[c], want[c]):
            assert same(None if pd.isna(a) else a, None if pd.isna(b) else b), (c, a, b)
