from __future__ import annotations

import numpy as np
import pandas as pd
import pytest
from helpers import to_spark

from airloom.operators import attach as attach_module
from airloom.operators.outliers import zscore_filter


def expected(pdf, columns, keys=("city",), min_rows=50, min_keep=0.8):
    """Screen each group column by column in plain pandas."""
    kept = []
    for _, part in pdf.groupby(list(keys)) if keys else [(None, pdf)]:
        big = len(part) >= min_rows
        for c in columns:
            std = part[c].std()
            if not big or not std > 0 or part[c].nunique() == 1:
                continue
            fits = ((part[c] - part[c].mean()) / std).abs() < 3
            if fits.mean() >= min_keep:
                part = part[fits]
        kept += list(part["id"])
    return sorted(kept)


@pytest.fixture(scope="module")
def skewed():
    rng = np.random.default_rng(3)
    n = {"big": 900, "small": 49, "fifty": 50, "holes": 300, "flat": 200}
    parts = []
    for city, size in n.items():
        p = pd.DataFrame({"city": city, "a": rng.exponential(5, size), "b": rng.normal(0, 1, size) ** 3,
                          "c": rng.standard_t(2, size)})
        if city == "holes":
            p.loc[p.index[:90], "b"] = np.nan  # 30 % would fail: the column is skipped
            p.loc[p.index[90:100], "c"] = np.nan  # few enough to be screened out
        if city == "flat":
            p["a"] = 27.7  # constant: the column is skipped and its gaps stay
            p.loc[p.index[:5], "a"] = np.nan
        parts.append(p)
    pdf = pd.concat(parts, ignore_index=True)
    pdf["id"] = range(len(pdf))
    return pdf


def ids(df):
    return sorted(r["id"] for r in df.select("id").collect())


@pytest.mark.parametrize("columns", [["a"], ["a", "b", "c"], ["c", "absent", "a"]])
def test_matches_sequential_screening(spark, skewed, columns):
    got = ids(zscore_filter(to_spark(spark, skewed), columns))
    want = expected(skewed, [c for c in columns if c in skewed])
    assert got == want and len(want) < len(skewed)


def test_whole_table(spark, skewed):
    got = ids(zscore_filter(to_spark(spark, skewed), ["a", "b"], keys=()))
    assert got == expected(skewed, ["a", "b"], keys=())


def test_many_keys_use_the_salted_join(spark, skewed, monkeypatch):
    monkeypatch.setattr(attach_module.attach, "__kwdefaults__",
                        {**attach_module.attach.__kwdefaults__, "broadcast_bytes": 0, "salts": 3})
    assert ids(zscore_filter(to_spark(spark, skewed), ["a", "c"])) == expected(skewed, ["a", "c"])


def test_nothing_to_screen(spark, skewed):
    df = to_spark(spark, skewed)
    assert zscore_filter(df, ["absent"]).count() == len(skewed)
    assert zscore_filter(df.limit(0), ["a"]).count() == 0
