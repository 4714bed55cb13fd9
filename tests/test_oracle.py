"""Every registered query with a SQL oracle equals DuckDB on sf0.001."""

import duckdb
import pytest

import __spark_entry__ as entry
from tools.oracle_check import TABLES, canon_rows

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_matches_duckdb(spark, con, name):
    got = entry.queries()[name](spark, SF).toPandas()
    exp = con.execute(entry.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(exp.columns)
    assert len(got) == len(exp)
    assert canon_rows(got) == canon_rows(exp)


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["action", "n_hours", "avg_rt", "avg_prc"]
    assert df.count() >= 1
