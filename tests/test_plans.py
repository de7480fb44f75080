"""Plan shapes that matter at scale."""

from __future__ import annotations

import re

import pytest

from airloom import fixtures as fx
from airloom import queries
from airloom.operators import stats
from airloom.operators import timeseries as tsop
from airloom.sources.tables import latest_by_key

FOLDER = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def daily(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("daily"))
    fx.readings_scale(spark, FOLDER).write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def test_no_query_builds_a_cross_product(spark):
    for name in ("weather_aqi_join", "nearest_join", "nearest_join_tolerance", "chrono_split", "cv_folds",
                 "corr_matrix", "feature_profile", "aqi_stats", "metadata_merge", "forecast_features"):
        text = plan(queries.QUERIES[name](spark, FOLDER))
        assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text, name


def test_filter_and_columns_reach_the_scan(daily):
    text = plan(daily.filter("city = 'city_1'").select("city", "us_aqi"))
    assert "PushedFilters: [IsNotNull(city), EqualTo(city,city_1)]" in text
    assert re.search(r"ReadSchema: struct<city:string,us_aqi:double>", text)


def test_top_rows_and_upsert_limit_before_the_shuffle(daily):
    for df in (tsop.last_rows(daily, 24), latest_by_key(daily.selectExpr("*", "1 AS seq"))):
        assert re.search(r"WindowGroupLimit.*Partial", plan(df))


def test_plain_window_shuffles_once(daily):
    assert plan(tsop.add_lags(daily, split=False)).count("Exchange hashpartitioning") == 1


def test_split_window_never_partitions_rows_by_city_alone(daily):
    text = plan(tsop.add_lags(daily, split=True))
    rows = [line for line in text.splitlines() if "Window [lag" in line]
    assert rows and all("_block" in line for line in rows)


def test_chrono_split_sorts_keys_only(daily):
    text = plan(tsop.chrono_split(daily, split=True))
    sorts = [line for line in text.splitlines() if "Sort [" in line and "ts#" in line]
    assert sorts and all("_bucket" in line for line in sorts)


def test_counts_read_key_columns_only(daily):
    text = plan(stats.table_counts({"daily": daily}))
    assert "ReadSchema: struct<>" in text
