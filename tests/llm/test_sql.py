"""Queries that SQL can express, against DuckDB."""

from __future__ import annotations

import glob

import duckdb
import pytest

from airloom.llm import queries
from check_oracles import compare

FOLDER = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for path in glob.glob(f"{FOLDER}/*.parquet"):
        con.execute(f"CREATE VIEW {path.split('/')[-1][:-8]} AS SELECT * FROM '{path}'")
    text, _, good = compare(spark, con, name, queries.QUERIES[name], queries.ORACLE_SQL[name], FOLDER)
    assert good, text
