"""Every query of the engine with SQL against DuckDB on the small tables."""

import os

import pandas as pd
import pytest

import __spark_entry__ as entry
from sheetwise.plans import catalog

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no tables here")


@pytest.fixture(scope="module")
def duck():
    import duckdb

    connection = duckdb.connect()
    for t in TABLES:
        connection.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return connection


def normal(frame, columns):
    def cell(v):
        if not isinstance(v, (list, dict)) and not hasattr(v, "__len__") and pd.isna(v):
            return None
        return float(v) if isinstance(v, (int, float)) and not isinstance(v, bool) else v

    return sorted((tuple(cell(v) for v in row) for row in frame[columns].astype(object).itertuples(index=False, name=None)), key=repr)


@pytest.mark.parametrize("name", sorted(catalog.oracle_sql()))
def test_against_sql(spark, duck, name):
    got, want = catalog.queries()[name](spark, SF).toPandas(), duck.sql(catalog.oracle_sql()[name]).df()
    columns = sorted(want.columns)
    assert sorted(got.columns) == columns
    assert normal(got, columns) == normal(want, columns)


def test_all_verdicts_occur(spark):
    found = {(r["status"], r["resolution_method"]) for r in entry.entry(spark).select("status", "resolution_method").distinct().collect()}
    assert {m for _, m in found} == {"perfect_match", "auto_resolved", "low_confidence", "manual_required", "vision_only"}
