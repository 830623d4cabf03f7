"""Queries with SQL against DuckDB on the smallest tables."""

import duckdb
import pytest

from furiframe.llm import queries
from tests.conftest import SF001
from tools.oracle_check import rows_of


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "labels", "benchmark", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    df = queries.QUERIES[name](spark, SF001)
    rel = con.sql(queries.ORACLES[name])
    assert sorted(df.columns) == sorted(rel.columns)
    assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == rows_of(rel.columns, rel.fetchall())


def test_names():
    assert sorted(int(k[2:].split("_")[0]) for k in queries.QUERIES) == list(range(1, 14))
