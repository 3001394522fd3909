"""The queries of this folder that SQL can express, against DuckDB on the small tables."""

import os

import pytest

from sheetwise.llm import queries

from ..test_queries import SF, TABLES, normal

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no tables here")


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_against_sql(spark, name):
    import duckdb

    connection = duckdb.connect()
    for t in TABLES:
        connection.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    got, want = queries.queries()[name](spark, SF).toPandas(), connection.sql(queries.oracle_sql()[name]).df()
    columns = sorted(want.columns)
    assert sorted(got.columns) == columns
    assert normal(got, columns) == normal(want, columns)
