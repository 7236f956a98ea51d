"""Every registered query with a SQL twin equals DuckDB on the sf0.01 tables."""

import pytest

import __spark_entry__ as E
from conftest import SF01
from oracle_harness import compare
from sessionbars.plans.catalog import QUERIES

ORACLE = E.oracle_sql()


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_duckdb(spark, name):
    r = compare(spark, name, SF01, E.queries()[name], ORACLE[name])
    assert r["cols_match"], r
    assert r["spark_rows"] == r["duck_rows"], r
    assert r["match"], r


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns[:3] == ["symbol", "datetime", "day_of_week"]
    assert df.count() > 0


def test_every_query_has_oracle_or_is_rows_only():
    rows_only = set(QUERIES) - set(ORACLE)
    assert rows_only <= {"gbt_fit", "rf_fit", "gbt2_fit", "enet_fit", "grid_search", "model_roundtrip",
                         "stream_signals"}
