from __future__ import annotations

import glob
import os

import duckdb
import pytest

import __spark_entry__ as entry
from airloom.oracles import oracle_sql
from airloom.queries import QUERIES
from check_oracles import compare

FOLDER = "/root/testdata/sf0.001"
ORACLES = oracle_sql()

#: The smallest tables leave no training rows after two days of lags; ``check_oracles.py`` runs these.
NEED_MODELS = {"train_compare", "score_forecast", "backtest", "feature_importance", "registered_features", "pipeline_forecast",
               "end_to_end"}

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="input tables are not here")


@pytest.fixture(scope="module")
def con():
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for path in glob.glob(f"{FOLDER}/*.parquet"):
        view = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {view} AS SELECT * FROM '{path}'")
    return con


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)
    assert not set(QUERIES) - set(ORACLES)


def test_entry(spark):
    assert set(QUERIES) <= set(entry.queries()) and ORACLES.items() <= entry.oracle_sql().items()
    df = entry.entry(spark)
    assert df.columns == ["city", "day", "avg_aqi", "min_aqi", "max_aqi", "category"] and df.count() > 0


@pytest.mark.parametrize("name", sorted(set(ORACLES) - NEED_MODELS))
def test_query_equals_oracle(spark, con, name):
    text, _, good = compare(spark, con, name, QUERIES[name], ORACLES[name], FOLDER)
    assert good, text
