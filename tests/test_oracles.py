"""Every core query with SQL, on the smallest tables, against DuckDB."""

import glob
import math
import os

import duckdb
import pytest

from bibspark.plans.oracles import oracle_sql
from bibspark.plans.queries import queries


@pytest.fixture(scope="module")
def duck(data):
    con = duckdb.connect()
    for p in glob.glob(f"{data}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(p)[:-8]} AS SELECT * FROM read_parquet('{p}')")
    return con


def rows(df):
    def one(x):
        if x is None or (isinstance(x, float) and math.isnan(x)):
            return ""
        if isinstance(x, bool) or type(x).__name__ == "bool_":
            return str(bool(x))
        try:
            return repr(round(float(x), 6)) if not isinstance(x, str) else x
        except (TypeError, ValueError):
            return "" if str(x) in ("NaT", "<NA>") else str(x)

    return sorted(tuple(one(x) for x in r) for r in df[sorted(df.columns)].itertuples(index=False))


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_equals_sql(spark, duck, data, name):
    got, want = queries()[name](spark, data).toPandas(), duck.execute(oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got) == rows(want)


def test_entry(spark):
    import __spark_entry__ as e

    assert {r.severity for r in e.entry(spark).collect()} <= {"critical", "high", "medium", "low"}
    assert set(e.oracle_sql()) <= set(e.queries())
