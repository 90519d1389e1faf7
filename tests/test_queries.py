"""Every registered query against its SQL in DuckDB, on the smallest tables."""

import glob
import os

import duckdb
import pytest

import codexlake.plans  # noqa: F401
from codexlake import catalog


@pytest.fixture(scope="module")
def duck(tiny):
    con = duckdb.connect()
    for path in glob.glob(f"{tiny}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return con


def rows(frame):
    columns = sorted(frame.columns)
    out = frame[columns].astype(object)
    return sorted(map(tuple, out.where(out.notna(), None).astype(str).to_numpy().tolist()))


@pytest.mark.parametrize("name", sorted(catalog.SQL))
def test_query_equals_sql(spark, duck, tiny, name):
    got = catalog.QUERIES[name](spark, tiny).toPandas()
    want = duck.execute(catalog.SQL[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got) == rows(want)


@pytest.mark.parametrize("name", sorted(set(catalog.QUERIES) - set(catalog.SQL)))
def test_query_without_sql_runs(spark, tiny, name):
    assert catalog.QUERIES[name](spark, tiny).count() > 0


def test_entry_survives_without_the_optional_operators(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(catalog.QUERIES) <= set(entry.queries()) and set(entry.oracle_sql()) <= set(entry.queries())
